"""Secret scans: candidate strings and a random forest that removes false positives, in DataFrame functions only.

Candidates in a white-space separated token are its runs of 16 or more key characters with a digit, what begins like a
key of a known service, and what is assigned to a name that speaks of secrets, of 6 characters or more; a candidate
within a longer one of its token counts for nothing. Their features are length, character transitions (how much likelier
their pairs of character classes are in secrets than in other strings, learnt from the labelled findings), shares of
characters, how much of them dictionary words cover, whether they are part of a path or stand in a path of tests, and the
words before and after them. The forest is trained in plain Python from labelled findings (those given, else a generated
set) and runs as nested CASE expressions.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.llm.common import INNER, table
from claimweft.llm.line_dedup import _fixed

MIN_LENGTH, MIN_ASSIGNED = 16, 6
#: Trees of the forest, their depth, least findings in a leaf, and features tried at a split.
TREES, DEPTH, LEAST, TRIED = 15, 7, 4, 6
THRESHOLD = 0.5
#: Labelled findings that are read for training at most, and those that are generated where none are given.
MOST_FINDINGS, FINDINGS = 20_000, 2400
SEED = 5

CORE = "[A-Za-z0-9+/_-]{16,}"
# What keys of known services begin with, words that a dictionary check looks for, and words beside secrets
# and beside other long strings.
SERVICE_KEYS = "(?:AKIA|ASIA)[A-Z0-9]{12,}|(?:ghp_|gho_|github_pat_|sk_live_|glpat-|npm_)[A-Za-z0-9_-]{12,}|xox[abp]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{16,}|AIza[A-Za-z0-9_-]{20,}"
DICTIONARY = "able|about|access|account|action|address|admin|after|again|all|also|amount|and|answer|application|array|attribute|author|back|base|batch|before|between|block|body|book|branch|bucket|build|button|cache|call|change|channel|chapter|check|child|class|client|cluster|code|color|column|command|commit|common|company|config|connect|console|container|content|context|control|count|country|create|current|customer|data|database|date|default|delete|demo|detail|device|document|domain|dummy|editor|element|email|error|event|example|export|factor|false|feature|field|file|filter|first|folder|format|from|function|general|global|group|handler|hash|header|height|hello|history|home|host|image|import|index|information|inner|input|instance|internal|item|job|join|key|language|last|layer|length|level|library|line|link|list|local|location|log|logger|main|manager|market|master|member|memory|message|method|model|module|month|name|network|node|none|null|number|object|option|order|other|output|owner|package|page|parent|part|password|path|pattern|person|phone|point|policy|price|process|product|profile|project|property|public|query|queue|random|record|region|release|report|request|response|result|return|row|sample|schema|script|search|secret|section|select|server|service|session|setting|simple|size|source|state|status|string|style|system|table|target|task|template|test|text|time|title|token|total|type|unit|update|user|value|version|view|width|window|word|your"
NEAR_SECRET = "api.?key|apikey|secret|token|passw|pwd|bearer|credential|private.?key|access.?key|auth"
NEAR_OTHER = "sha1|sha256|md5|commit|hash|checksum|digest|uuid|guid|revision|build|version|isbn|card|iban|phone|order|invoice|img|src|href"
TEST_PATH = "test|example|sample|fixture|mock|demo|dummy"
IN_PATH = r"://|@|\.[a-z]{2,5}(/|$)|^/|[^=]/[a-z]+/"
#: A name that speaks of secrets and a sign of assignment; the same at the end of the words before; the assigned value.
NAMED = "(?i)(?:api.?key|secret|token|passw(?:or)?d|passwd|pwd|bearer|credential|private.?key|access.?key|auth)[a-z_]*[\"']?[ ]*[:=]+[ ]*[\"']*"
VALUE = "([^\"',;]{6,})"
FEATURES = ("length", "turns", "transition", "digit_share", "upper_share", "sign_share", "distinct_share", "covered", "in_path", "in_test_path", "near_secret", "near_other", "after_other", "known_prefix", "assigned")
#: Characters by class, in this order: other signs, digits, capitals, vowels, other small letters.
CLASSES = (("[^A-Za-z0-9]", "#"), ("[0-9]", "0"), ("[A-Z]", "A"), ("[aeiou]", "~"), ("[a-z]", "b"))
PAIRS = [a + b for _, a in CLASSES for _, b in CLASSES]

#: A finding: the secret, its token, the words before it, the word after it, the path, and whether it is a secret.
Finding = tuple[str, str, str, str, str, bool]


# ---- features: one definition in Python for training, one as expressions ---------------------------------------------


def shape(core: str) -> str:
    for pattern, sign in CLASSES:
        core = re.sub(pattern, sign, core)
    return core


def pair_weights(findings: list[Finding]) -> dict[str, int]:
    """A thousand times the log of how much likelier each pair of classes is in secrets than in other strings."""
    seen = {True: Counter(), False: Counter()}
    for core, *_, secret in findings:
        s = shape(core)
        seen[secret].update(a + b for a, b in zip(s, s[1:]))
    total = {k: sum(c.values()) + len(PAIRS) for k, c in seen.items()}
    return {p: round(1000 * (math.log((seen[True][p] + 1) / total[True]) - math.log((seen[False][p] + 1) / total[False]))) for p in PAIRS}


def features(core: str, token: str, before: str, after: str, path: str, pairs: dict[str, int]) -> list[float]:
    n = len(core)
    count = lambda p, s=core: len(re.findall(p, s))
    turns = count("[A-Za-z][0-9]") + count("[0-9][A-Za-z]") + count("[a-z][A-Z]") + count("[A-Z][a-z]")
    beside = f"{before} {token.replace(core, ' ', 1)}".lower()
    s = shape(core)
    yes = lambda p, t: float(bool(re.search(p, t)))
    return [
        float(n), turns / n, sum(pairs[a + b] for a, b in zip(s, s[1:])) / n, count("[0-9]") / n, count("[A-Z]") / n, count("[^A-Za-z0-9]") / n, len(set(core)) / n,
        sum(map(len, re.findall(DICTIONARY, core.lower()))) / n, yes(IN_PATH, token), yes(TEST_PATH, path.lower()), yes(NEAR_SECRET, beside), yes(NEAR_OTHER, beside),
        yes(NEAR_OTHER, after.lower()), yes(f"^(?:{SERVICE_KEYS})", core), yes(NAMED + "$", f"{before} {token[: token.index(core)]}"),
    ]


def feature_columns(core: Column, token: Column, before: Column, after: Column, path: Column, pairs: dict[str, int]) -> dict[str, Column]:
    n = F.length(core).cast("double")
    count = lambda p: F.regexp_count(core, F.lit(p))
    turns = count("[A-Za-z][0-9]") + count("[0-9][A-Za-z]") + count("[a-z][A-Z]") + count("[A-Z][a-z]")
    at = F.instr(token, core)
    ahead = F.concat(before, F.lit(" "), F.substring(token, F.lit(1), at - 1))
    beside = F.lower(F.concat(ahead, F.lit(" "), F.substring(token, at + F.length(core), F.length(token))))
    shaped = reduce(lambda c, k: F.regexp_replace(c, *k), CLASSES, core)
    weight = F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))
    yes = lambda c: c.cast("double")
    return {
        "length": n, "turns": turns / n, "transition": F.aggregate(F.sequence(F.lit(1), F.length(core) - 1), F.lit(0), lambda s, i: s + F.element_at(weight, F.substring(shaped, i, F.lit(2)))) / n,
        "digit_share": count("[0-9]") / n, "upper_share": count("[A-Z]") / n, "sign_share": count("[^A-Za-z0-9]") / n, "distinct_share": F.size(F.array_distinct(F.split(core, ""))) / n,
        "covered": (F.length(core) - F.length(F.regexp_replace(F.lower(core), DICTIONARY, ""))) / n, "in_path": yes(token.rlike(IN_PATH)), "in_test_path": yes(F.lower(path).rlike(TEST_PATH)),
        "near_secret": yes(beside.rlike(NEAR_SECRET)), "near_other": yes(beside.rlike(NEAR_OTHER)), "after_other": yes(F.lower(after).rlike(NEAR_OTHER)), "known_prefix": yes(core.rlike(f"^(?:{SERVICE_KEYS})")), "assigned": yes(ahead.rlike(NAMED + "$")),
    }


# ---- labelled findings and the forest -----------------------------------------------------------------------------


def generated_findings(n: int = FINDINGS, seed: int = SEED) -> list[Finding]:
    """Findings made by rule: keys and passwords of usual forms, and look-alikes."""
    r = random.Random(seed)
    hexes, base, lower = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz"
    some = lambda a, k: "".join(r.choice(a) for _ in range(k))
    vocabulary = DICTIONARY.split("|")
    prose = ["it", "was", "the", "of", "and", "una", "les", "der", "in", "for", "that"]
    keys = ["token", "api_key", "apikey", "secret", "password", "passwd", "access_key", "auth_token", "client_secret", "bearer"]
    others = ["commit", "sha256", "md5", "checksum", "uuid", "revision", "card", "order", "invoice", "build", "hash"]
    paths = ["src/app", "lib/core", "config/prod", "src0", "web", "tests/unit", "docs/example", "spec/fixtures"]
    out: list[Finding] = []
    while len(out) < n:
        kind, path = r.randrange(19), r.choice(paths)
        lead, after = " ".join(r.choices(prose, k=2)), r.choice([*prose, "", ";", "#"])
        joint = r.choice(["=", " = ", ": ", ":", "=\"", " = \""])
        key = r.choice(keys)
        quote = "\"" if '"' in joint else ""
        sign = joint.strip(" " + chr(34))
        named = (f"{key}{joint}", lead) if not joint.count(" ") else (quote, f"{key} {sign}" if joint[0] == " " else f"{r.choice(prose)} {key}{sign}")
        if kind < 5:
            core = [some(hexes, r.choice([18, 32, 40, 64])), some(base, r.choice([20, 24, 32, 40])), some(hexes, 18), some(hexes, 40), some(base, 32)][kind]
            row = (core, named[0] + core + quote, named[1], after, path, True)
        elif kind < 7:
            core = r.choice(["AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), "ghp_" + some(base, 36), "sk-" + some(base, 32), "xoxb-" + some("0123456789", 12) + "-" + some(base, 24), "AIza" + some(base, 35)])
            row = (core, r.choice(["", "", "key="]) + core, lead, after, path, True)
        elif kind < 9:  # passwords: words with figures and signs, or letters without sense
            core = r.choice([r.choice(vocabulary).title() + some("0123456789", r.randint(1, 4)) + r.choice("!?#$%&*"), some(base + "!#$%&*?@^", r.randint(8, 16)), some(lower, r.randint(8, 20)), r.choice("!#$") + some(lower, 6) + some("0123456789", 2)])
            row = (core, named[0] + core + quote, named[1], after, path, True)
        elif kind == 9:
            core = some("0123456789", 16)
            row = (core, core, r.choice([lead, "card number", "invoice no"]), after, path, False)
        elif kind == 10:
            core = "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12))
            row = (core, core, r.choice(["request uuid", lead, "id"]), after, path, False)
        elif kind == 11:
            core = some(hexes, r.choice([32, 40, 64]))
            row = (core, core, f"{r.choice(prose)} {r.choice(others)}", after, path, False)
        elif kind == 12:
            core = some(hexes, r.choice([32, 40, 64]))
            row = (core, core, lead, r.choice(others), path, False)
        elif kind == 13:
            core = r.choice("_-").join(r.choices(vocabulary, k=r.randint(2, 4))) + str(r.randint(1, 999))
            row = (core.ljust(16, "1"), core.ljust(16, "1"), lead, after, path, False)
        elif kind == 14:
            core = r.choice(["your_api_key_here_123", "example-token-0000000", "test1234test1234test", "XXXXXXXXXXXXXXXX0000", "1234567890abcdef1234", "changeme-password-123", "xxxxxxxx", "********", "<password>", "changeme", "placeholder"])
            row = (core, f"{key}={core}", lead, after, path, False)
        elif kind == 15:  # assigned, but words: names, types, calls
            core = r.choice([r.choice(vocabulary) + r.choice(["_", ".", "-"]) + r.choice(vocabulary), r.choice(vocabulary) + "()", "${" + r.choice(vocabulary).upper() + "_" + r.choice(vocabulary).upper() + "}", "string", "required", r.choice(vocabulary) + "." + r.choice(vocabulary) + "()", "process.env." + r.choice(vocabulary).upper()])
            core = core if len(core) >= MIN_ASSIGNED else core + "_value"
            row = (core, named[0] + core + quote, named[1], after, path, False)
        elif kind == 16:
            core = "/".join(r.choices(vocabulary, k=4)) + f"/v{r.randint(1, 9)}"
            row = (core, r.choice(["https://example.com/", "/"]) + core, lead, after, path, False)
        elif kind == 17:
            core = "".join(r.choice(vocabulary).title() for _ in range(3)) + str(r.randint(10, 9999))
            row = (core.ljust(16, "2"), core.ljust(16, "2"), lead, after, path, False)
        else:
            core = some("0123456789", r.choice([16, 18, 20]))
            row = (core, core, lead, r.choice([*prose, *others]), path, False)
        out.append(row)
    return out


def labelled_findings(findings: DataFrame, most: int = MOST_FINDINGS) -> list[Finding]:
    """A bounded sample of a table of labelled findings: secret, token, before, after, path (strings) and label (boolean).

    Chosen by a hash of the row. Null strings are empty; rows without a secret, a label or the secret in the token are
    left out.
    """
    names = ("secret", "token", "before", "after", "path")
    rows = findings.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names), F.col("label").cast("boolean").alias("label"))
    rows = rows.where((F.col("secret") != "") & F.col("label").isNotNull() & F.contains("token", F.col("secret")))
    return [tuple(r) for r in rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(most).collect()]


def _grow(rows: list[tuple[list[float], bool]], depth: int, r: random.Random):
    """A leaf's share of secrets, or (feature, threshold, at most it, above it)."""
    share = sum(y for _, y in rows) / len(rows)
    if depth == 0 or len(rows) < 2 * LEAST or share in (0.0, 1.0):
        return round(share, 6)
    best = None
    for f in r.sample(range(len(FEATURES)), TRIED):
        ordered = sorted((x[f], y) for x, y in rows)
        total, left, n = sum(y for _, y in ordered), 0, len(ordered)
        for i in range(1, n):
            left += ordered[i - 1][1]
            if ordered[i][0] > ordered[i - 1][0] and LEAST <= i <= n - LEAST:
                a, b = left / i, (total - left) / (n - i)
                impurity = i * a * (1 - a) + (n - i) * b * (1 - b)
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, round((ordered[i][0] + ordered[i - 1][0]) / 2, 6))
    if best is None:
        return round(share, 6)
    _, f, cut = best
    low, high = [x for x in rows if x[0][f] <= cut], [x for x in rows if x[0][f] > cut]
    if not low or not high:
        return round(share, 6)
    return f, cut, _grow(low, depth - 1, r), _grow(high, depth - 1, r)


Forest = tuple[list, dict[str, int]]


def train_forest(findings: list[Finding] | None = None, trees: int = TREES, seed: int = SEED) -> Forest:
    """Trees on bootstrap samples of labelled findings, and the weights of character transitions."""
    findings = generated_findings() if findings is None else findings
    if not findings:
        raise ValueError("no labelled findings")
    pairs = pair_weights(findings)
    rows = [(features(*f[:5], pairs), f[5]) for f in findings]
    r = random.Random(seed)
    return [_grow(r.choices(rows, k=len(rows)), DEPTH, r) for _ in range(trees)], pairs


def share_of_trees(forest: Forest, finding: tuple) -> float:
    """The forest's score of one finding, in plain Python."""
    x = features(*finding[:5], forest[1])

    def leaf(t):
        while isinstance(t, tuple):
            t = t[2] if x[t[0]] <= t[1] else t[3]
        return t

    return sum(map(leaf, forest[0])) / len(forest[0])


def tree_sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"CAST({tree!r} AS DOUBLE)"
    f, cut, low, high = tree
    return f"CASE WHEN {FEATURES[f]} <= CAST({cut!r} AS DOUBLE) THEN {tree_sql(low)} ELSE {tree_sql(high)} END"


def forest_sql(forest: Forest) -> str:
    return "(" + " + ".join(map(tree_sql, forest[0])) + f") / {len(forest[0])}"


# ---- operator -----------------------------------------------------------------------------------------------------


def scan(docs: DataFrame, forest: Forest | None = None, threshold: float = THRESHOLD, path: str | None = "source") -> DataFrame:
    """Findings that the forest keeps: doc_id, place (the token's number from 0), secret, score.

    ``path`` names a column that tells where a text is from, or None. Null and empty texts have no finding; repeated
    rows give repeated findings; other columns aren't read. Needs no shuffle.
    """
    forest = train_forest() if forest is None else forest
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    text, tokens, at = f"{INNER}text", f"{INNER}tokens", f"{INNER}path"
    base = docs.select("doc_id", where.alias(at), F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text)).where(F.col(text).rlike(CORE) | F.col(text).rlike(SERVICE_KEYS) | F.col(text).rlike(NEAR_SECRET_ASSIGNED))
    split = _fixed(base, **{tokens: F.split(text, "[ \t\r\n\f\x0b]+", -1)}).drop(text)
    word = lambda i: F.coalesce(F.when(i >= 0, F.get(tokens, i)), F.lit(""))
    open_ = lambda i: word(i - 1).rlike(OPEN)
    hits = F.filter(F.transform(tokens, lambda t, i: F.struct(i.alias("place"), t.alias("token"))), lambda s: (F.length(s["token"]) >= MIN_ASSIGNED) & (s["token"].rlike(CORE) | s["token"].rlike(SERVICE_KEYS) | s["token"].rlike(NAMED) | open_(s["place"])))
    around = lambda s: F.struct(s["place"].alias("place"), s["token"].alias("token"), F.concat_ws(" ", word(s["place"] - 2), word(s["place"] - 1)).alias("before"), word(s["place"] + 1).alias("after"))
    each = split.select("doc_id", at, F.explode(F.transform(hits, around)).alias("c")).select("doc_id", at, "c.*")
    token, found = F.col("token"), f"{INNER}found"
    assigned = F.when(F.col("before").rlike(NAMED + "$"), F.regexp_extract(token, "^[\"']*" + VALUE, 1)).otherwise(F.lit(""))
    every = F.array_distinct(F.concat(
        F.filter(F.regexp_extract_all(token, F.lit(CORE), F.lit(0)), lambda c: c.rlike("[0-9]")), F.regexp_extract_all(token, F.lit(SERVICE_KEYS), F.lit(0)), F.array(F.regexp_extract(token, NAMED + VALUE, 1), assigned)))
    candidates = _fixed(each, **{found: every})
    whole = F.filter(found, lambda c: (c != "") & ~F.exists(found, lambda d: (d != c) & F.contains(d, c)))
    core = candidates.select("doc_id", "place", "token", "before", "after", at, F.explode(whole).alias("secret"))
    known = _fixed(core, **feature_columns(F.col("secret"), token, F.col("before"), F.col("after"), F.col(at), forest[1]))
    return known.select("doc_id", "place", "secret", F.round(F.expr(forest_sql(forest)), 6).alias("score")).where(F.col("score") >= threshold)


#: What a text has where something is assigned to a naming word, within a token or over tokens; how the token before ends.
NEAR_SECRET_ASSIGNED = NAMED.replace("[ ]*", "[ \t\r\n\f\x0b]*")
OPEN = "[:=][\"']?$"


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All findings in all documents, as digests; see ``scan`` for nulls, empty texts and repeated rows."""
    found = scan(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source"))
    return found.select("doc_id", "place", F.length("secret").alias("secret_length"), F.sha2("secret", 256).alias("secret_sha256"), "score")


def oracle() -> str:
    forest = train_forest()
    q = lambda s: "'" + s.replace("'", "''") + "'"
    count = lambda p: f"len(regexp_extract_all(secret, '{p}'))"
    ahead = "(before || ' ' || substr(token, 1, strpos(token, secret) - 1))"
    beside = f"lower({ahead} || ' ' || substr(token, strpos(token, secret) + length(secret)))"
    yes = lambda s, p: f"CAST(regexp_matches({s}, {q(p)}) AS DOUBLE)"
    n = "CAST(length(secret) AS DOUBLE)"
    shaped = reduce(lambda e, k: f"regexp_replace({e}, '{k[0]}', '{k[1]}', 'g')", CLASSES, "secret")
    weights = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in forest[1].items()) + "}"
    exprs = {
        "length": n, "turns": f"({count('[A-Za-z][0-9]')} + {count('[0-9][A-Za-z]')} + {count('[a-z][A-Z]')} + {count('[A-Z][a-z]')}) / {n}",
        "transition": f"list_sum(list_transform(range(1, length(secret)), lambda i: {weights}[substr({shaped}, i::INT, 2)])) / {n}",
        "digit_share": f"{count('[0-9]')} / {n}", "upper_share": f"{count('[A-Z]')} / {n}", "sign_share": f"{count('[^A-Za-z0-9]')} / {n}", "distinct_share": f"len(list_distinct(string_split(secret, ''))) / {n}",
        "covered": f"(length(secret) - length(regexp_replace(lower(secret), '{DICTIONARY}', '', 'g'))) / {n}", "in_path": yes("token", IN_PATH), "in_test_path": yes("lower(path)", TEST_PATH),
        "near_secret": yes(beside, NEAR_SECRET), "near_other": yes(beside, NEAR_OTHER), "after_other": yes("lower(after)", NEAR_OTHER), "known_prefix": yes("secret", f"^(?:{SERVICE_KEYS})"), "assigned": yes(ahead, NAMED + "$"),
    }
    renamed = re.sub(r"\b(" + "|".join(FEATURES) + r")\b", r"f_\1", forest_sql(forest))
    return f"""
WITH tokens AS (
  SELECT doc_id, coalesce(source, '') AS path, string_split_regex(coalesce(text, ''), '[ \\t\\r\\n\\f\\x0b]+') AS w FROM documents
), placed AS (
  SELECT doc_id, path, generate_subscripts(w, 1) - 1 AS place, unnest(w) AS token, w FROM tokens
), around AS (
  SELECT doc_id, path, place::INT AS place, token, coalesce(CASE WHEN place >= 2 THEN w[place - 1] END, '') || ' ' || coalesce(CASE WHEN place >= 1 THEN w[place] END, '') AS before, coalesce(w[place + 2], '') AS after
  FROM placed WHERE length(token) >= {MIN_ASSIGNED}
), found AS (
  SELECT *, list_distinct(list_concat(list_filter(regexp_extract_all(token, '{CORE}'), lambda c: regexp_matches(c, '[0-9]')), regexp_extract_all(token, '{SERVICE_KEYS}'),
    [regexp_extract(token, {q(NAMED + VALUE)}, 1), CASE WHEN regexp_matches(before, {q(NAMED + "$")}) THEN regexp_extract(token, {q("^[" + chr(34) + chr(39) + "]*" + VALUE)}, 1) ELSE '' END])) AS c FROM around
), cores AS (
  SELECT * EXCLUDE (c), unnest(list_filter(c, lambda x: x <> '' AND len(list_filter(c, lambda y: y <> x AND contains(y, x))) = 0)) AS secret FROM found WHERE len(c) > 0
), known AS (
  SELECT *, {", ".join(f"{e} AS f_{k}" for k, e in exprs.items())} FROM cores
), scored AS (SELECT doc_id, place, secret, round({renamed}, 6) AS score FROM known)
SELECT doc_id, place, length(secret)::INT AS secret_length, sha256(secret) AS secret_sha256, score FROM scored WHERE score >= {THRESHOLD}
"""
