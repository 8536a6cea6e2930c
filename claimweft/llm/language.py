"""Language identification with a linear-chain conditional random field over words.

Word features are affixes, byte n-grams and membership in word lists learnt per language; transitions between the
languages of neighbouring words are learnt from code-switched sequences put together from labelled documents. Words
are labelled by forward-backward, so a text may switch languages; a document's language is the one with the largest
sum of word posteriors and its score is their mean.

The model is fitted on the driver on a bounded sample: TRAIN_DOCS documents of each of at most TRAIN_LANGS languages,
TRAIN_CHARS characters of each at most. Prediction reads every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm.common import flat, lean, mix, row_bounds, ship, slices, span_hashes, table

TRAIN_DOCS = 300
TRAIN_CHARS = 6000
TRAIN_LANGS = 64
#: Words in a training sequence and the number of sequences.
SEQUENCE_WORDS = 40
SEQUENCES = 3000
ROUNDS = 40
#: Rows of the hashed feature table.
TABLE = 1 << 16
LEXICON_WORDS = 4000
UNDETERMINED = "und"
SEED = 11
PREDICT_BYTES = 1 << 20


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and two-byte Latin letters in lower case."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] |= 32
    latin = np.zeros(len(data), bool)
    if len(data) > 1:
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[latin] += 32
    return out


def letter_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and row of each run of letters; a byte beyond ASCII counts as a letter."""
    data, offsets = flat(column)
    data = lowered(data)
    n = len(data)
    solid = ((data >= 97) & (data <= 122)) | (data >= 128)
    edge = np.zeros(n + 1, bool)
    edge[offsets[:-1][offsets[:-1] < n]] = True
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:n]
    ends[:-1] &= ~solid[1:] | edge[1:n]
    s = np.flatnonzero(starts)
    return data, s, np.flatnonzero(ends) + 1, np.searchsorted(offsets, s, "right") - 1


def distinct(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each distinct word, the number of one of its places, and for each word its number among them."""
    h = span_hashes(data, s, e)
    return np.unique(h, return_index=True, return_inverse=True)


def word_features(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the feature table for each word, one after another, and the n + 1 bounds of the words in them.

    With marks at both ends: all byte 2-grams and 3-grams, and 4-, 5- and 6-grams at the word's start and end.
    """
    length = e - s + 2
    bounds = np.concatenate([[0], np.cumsum(length)])
    n = int(bounds[-1])
    word = np.repeat(np.arange(len(s)), length)
    at = np.arange(n) - bounds[word]
    size = length[word]
    marked = np.where((at == 0) | (at == size - 1), 1, data[np.minimum(s[word] + np.maximum(at - 1, 0), max(len(data) - 1, 0))] if len(data) else 1).astype(np.uint64)
    out_word, out_index = [], []
    gram = marked.copy()
    for order in range(2, 7):
        gram = gram[: n - order + 1] + (marked[order - 1 :] << np.uint64(8 * (order - 1))) if n >= order else gram[:0]
        m = len(gram)
        inside = at[:m] + order <= size[:m]
        if order > 3:
            inside &= (at[:m] == 0) | (at[:m] + order == size[:m])
        keep = np.flatnonzero(inside)
        with np.errstate(over="ignore"):
            out_index.append((mix(gram[keep] * np.uint64(8) + np.uint64(order)) % np.uint64(TABLE)).astype(np.int32))
        out_word.append(word[keep])
    w = np.concatenate(out_word)
    order = np.argsort(w, kind="stable")
    return np.concatenate(out_index)[order], row_bounds(w[order], len(s))


class Model:
    """Languages, feature weights, transitions, start weights, and the word lists with their weights."""

    def __init__(self, langs: list[str]):
        k = len(langs)
        self.langs = langs
        self.weights = np.zeros((TABLE, k), np.float32)
        self.transitions = np.zeros((k, k), np.float32)
        self.start = np.zeros(k, np.float32)
        self.lexicon = np.zeros(0, np.uint64)
        self.member = np.zeros((0, k), np.float32)
        self.lexicon_weights = np.zeros((k, k), np.float32)

    def in_lists(self, h: np.ndarray) -> np.ndarray:
        """(words, languages): 1 where the word is in the language's list."""
        if not len(self.lexicon):
            return np.zeros((len(h), len(self.langs)), np.float32)
        at = np.minimum(np.searchsorted(self.lexicon, h), len(self.lexicon) - 1)
        return self.member[at] * (self.lexicon[at] == h)[:, None]

    def emissions(self, index: np.ndarray, bounds: np.ndarray, lists: np.ndarray) -> np.ndarray:
        e = np.add.reduceat(self.weights[index], bounds[:-1], axis=0) if len(index) else np.zeros((len(bounds) - 1, len(self.langs)), np.float32)
        return e + lists @ self.lexicon_weights


def forward_backward(emission: np.ndarray, active: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of chains that are stored step by step.

    ``emission`` has the exponentiated, scaled scores: first the first words of all chains, then the second words of
    those that have two, and so on, chains in order of falling length; ``active`` has how many chains have a step.
    Returns word posteriors (rows sum to 1), and the scaled forward and backward messages.
    """
    a = np.exp(transitions)
    bounds = np.concatenate([[0], np.cumsum(active)]).tolist()
    ahead = np.empty_like(emission)
    message = np.exp(start) * emission[: bounds[1]]
    for t in range(len(active)):
        lo, hi = bounds[t], bounds[t + 1]
        if t:
            message = (message[: hi - lo] @ a) * emission[lo:hi]
        message = message / message.sum(axis=1, keepdims=True)
        ahead[lo:hi] = message
    back = np.ones_like(emission)
    at = a.T.copy()
    for t in range(len(active) - 2, -1, -1):
        lo, mid, hi = bounds[t], bounds[t + 1], bounds[t + 2]
        m = (back[mid:hi] * emission[mid:hi]) @ at
        m /= m.sum(axis=1, keepdims=True)
        back[lo : lo + hi - mid] = m
    post = ahead * back
    post /= post.sum(axis=1, keepdims=True)
    return post, ahead, back


def scaled(e: np.ndarray) -> np.ndarray:
    """Exponentiated scores, the largest of each word 1, and none so small that a chain could vanish."""
    return np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -30.0)).astype(np.float32)


def train(texts: list[str], labels: list[str], seed: int = SEED) -> Model:
    """Fit the model by gradient steps (Adam) on the likelihood of code-switched sequences, with forward-backward."""
    langs = sorted(set(labels))
    model = Model(langs)
    if len(langs) < 2:
        return model
    k = len(langs)
    data, s, e, rows = letter_words(pa.array(texts, pa.large_string()))
    if not len(s):
        return model
    h, first, number = distinct(data, s, e)
    label = np.asarray([langs.index(x) for x in labels])[rows]
    # word lists: the most frequent words of which more than half the uses are in one language
    uses = np.stack([np.bincount(number[label == i], minlength=len(h)) for i in range(k)], axis=1)
    total = uses.sum(axis=1)
    common = np.zeros_like(uses, bool)
    for i in range(k):
        own = np.flatnonzero((uses[:, i] >= 3) & (2 * uses[:, i] > total))
        common[own[np.argsort(-uses[own, i], kind="stable")[:LEXICON_WORDS]], i] = True
    listed = np.flatnonzero(common.any(axis=1))
    model.lexicon, model.member = h[listed], common[listed].astype(np.float32)
    # sequences: stretches of one to SEQUENCE_WORDS words from documents of random languages
    rng = np.random.default_rng(seed)
    by_lang = [np.flatnonzero(label == i) for i in range(k)]
    present = [i for i in range(k) if len(by_lang[i])]
    words_at = np.empty((SEQUENCE_WORDS, SEQUENCES), np.int64)
    truth = np.empty((SEQUENCE_WORDS, SEQUENCES), np.int64)
    for j in range(SEQUENCES):
        at = 0
        while at < SEQUENCE_WORDS:
            lang = present[int(rng.integers(len(present)))]
            n = min(SEQUENCE_WORDS - at, int(rng.geometric(1 / 20)))
            from_ = int(rng.integers(max(1, len(by_lang[lang]) - n + 1)))
            own = by_lang[lang][from_ : from_ + n]
            words_at[at : at + len(own), j], truth[at : at + len(own), j] = number[own], lang
            at += len(own)
    words_at, truth = words_at.reshape(-1), truth.reshape(-1)
    used, back_to = np.unique(words_at, return_inverse=True)
    index, bounds = word_features(data, s[first[used]], e[first[used]])
    lists = model.in_lists(h[used])
    each = np.repeat(np.arange(len(used)), np.diff(bounds))
    active = np.full(SEQUENCE_WORDS, SEQUENCES)
    n_words = len(words_at)
    right = np.zeros((n_words, k), np.float32)
    right[np.arange(n_words), truth] = 1
    steps = truth.reshape(SEQUENCE_WORDS, SEQUENCES)
    seen = np.bincount((steps[:-1] * k + steps[1:]).reshape(-1), minlength=k * k).reshape(k, k)
    names = ("weights", "lexicon_weights", "transitions", "start")
    slow = {n: (np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))) for n in names}
    for r in range(1, ROUNDS + 1):
        em = scaled(model.emissions(index, bounds, lists)[back_to])
        post, ahead, back = forward_backward(em, active, model.transitions, model.start)
        gap = right - post
        by_word = np.stack([np.bincount(back_to, gap[:, i], len(used)) for i in range(k)], axis=1)
        pair = (ahead[:-SEQUENCES, :, None] * np.exp(model.transitions)) * (em * back)[SEQUENCES:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        gradient = {
            "weights": np.stack([np.bincount(index, by_word[each, i], TABLE) for i in range(k)], axis=1),
            "lexicon_weights": lists.T @ by_word,
            "transitions": seen - pair.sum(axis=0),
            "start": gap[:SEQUENCES].sum(axis=0),
        }
        for n in names:
            value = getattr(model, n)
            g = gradient[n] / n_words * 100 - 1e-3 * value
            m, v = slow[n]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += (0.15 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-6)).astype(np.float32)
    return model


def posteriors(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end, row and language posteriors of each word of the texts, by forward-backward."""
    n = len(column)
    data, s, e, rows = letter_words(column)
    if not len(s) or not model.langs:
        return data, s, e, rows, np.zeros((len(s), len(model.langs)), np.float32)
    h, first, number = distinct(data, s, e)
    index, bounds = word_features(data, s[first], e[first])
    em = scaled(model.emissions(index, bounds, model.in_lists(h)))
    row_at = row_bounds(rows, n)
    order = np.argsort(-np.diff(row_at), kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    place = np.arange(len(s)) - row_at[rows]
    active = np.bincount(place)
    at = np.concatenate([[0], np.cumsum(active)])[place] + rank[rows]
    step = np.empty(len(s), np.int64)
    step[at] = np.arange(len(s))
    post, _, _ = forward_backward(em[number[step]], active, model.transitions, model.start)
    return data, s, e, rows, post[at]


def predict(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; UNDETERMINED and 0 for a text that is null or has no letter, or with no model."""
    n = len(column)
    langs, score = [UNDETERMINED] * n, np.zeros(n)
    data, s, _, rows, post = posteriors(column, model)
    if not len(s) or not model.langs:
        return langs, score
    length = np.bincount(rows, minlength=n)
    sums = np.stack([np.bincount(rows, post[:, i], n) for i in range(len(model.langs))], axis=1)
    best = sums.argmax(axis=1)
    ascii_letters = np.bincount(rows, (data[s] < 128), n) > 0
    for i in np.flatnonzero(length > 0).tolist():
        if ascii_letters[i] or any(map(str.isalpha, column[i].as_py())):
            langs[i] = model.langs[best[i]]
            score[i] = min(1.0, sums[i, best[i]] / length[i])
    return langs, score


def word_languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, word_no (from 0), word (in lower case), lang, score: the language of each word of code-switched texts.

    Null, empty and letterless texts have no words; repeated rows give repeated words; other columns aren't read.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", PREDICT_BYTES):
                data, s, e, rows, post = posteriors(part.column("text"), sent.value)
                if not sent.value.langs:
                    continue
                raw, best = data.tobytes(), post.argmax(axis=1) if len(s) else np.zeros(0, np.int64)
                number = np.arange(len(s)) - row_bounds(rows, part.num_rows)[rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows)), pa.array(number, pa.int32()), pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(s.tolist(), e.tolist())], pa.string()), pa.array([sent.value.langs[i] for i in best.tolist()], pa.string()), pa.array(post[np.arange(len(s)), best].astype(np.float64))],
                    ["doc_id", "word_no", "word", "lang", "score"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "doc_id long, word_no int, word string, lang string, score double")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, docs_per_lang: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> Model:
    """Train on a bounded sample of the labelled rows that aren't held out, chosen by a hash of doc_id.

    Of a text longer than ``chars`` a stretch of so many characters is read, from a place chosen by that hash too.
    """
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    chance = F.xxhash64(F.col("doc_id").cast("long"), F.lit(SEED))
    from_ = F.pmod(chance, F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    stretch = F.substring("text", from_.cast("int"), F.lit(chars))
    best = labelled.select("doc_id", "lang", stretch.alias("text"), chance.alias("chance")).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("chance", "doc_id", "text"))).where(F.col("n") <= docs_per_lang)
    rows = best.orderBy(F.col("n"), F.col("lang")).limit(docs_per_lang * TRAIN_LANGS).select("text", "lang").collect()
    return train([r[0] for r in rows], [r[1] for r in rows])


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Add lang_pred and score to docs, whose other columns stay (clashing names are replaced). No shuffle to predict.

    Only ``text`` is an input of a prediction. Null, empty and letterless texts: ``und`` and 0. Equal texts get equal
    languages. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    model = fit(docs) if model is None else model
    docs = docs.drop("lang_pred", "score")
    sent = spark.sparkContext.broadcast(model)  # a table of fixed size

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", PREDICT_BYTES):
                langs, score = predict(part.column("text"), sent.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(score)], [*part.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(lean(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, score double")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those not held out. A null doc_id is not held out.

    Null, empty and letterless texts are ``und`` with score 0; so are all if no document has a label.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return identify(docs.select("doc_id", "text"), fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
