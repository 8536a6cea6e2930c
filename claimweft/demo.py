"""A small run to look at: a chat, a transcript, blocks and images written as files, and the stages over them."""

from __future__ import annotations

import json
import struct
import zlib
from pathlib import Path

CHAT = {"conversation_id": "harbour", "messages": [
    {"id": "m1", "author": {"id": "ann", "display_name": "Ann"}, "role": "user", "timestamp": "2026-05-04T09:00:00Z", "text": "Was the crane repaired?"},
    {"id": "m2", "author": {"id": "ben", "display_name": "Ben"}, "role": "external", "timestamp": "2026-05-04T09:01:00Z", "text": "I saw Berta on Tuesday. She has two cables."},
    {"id": "m3", "author": {"id": "ann", "display_name": "Ann"}, "role": "user", "timestamp": "2026-05-04T09:02:00Z", "text": "Thanks"},
    {"id": "m4", "author": {"id": "bot"}, "role": "bot", "timestamp": "2026-05-04T09:03:00Z", "text": "The cable may be worn. It was not replaced."},
]}
AUDIO = {"language": "en", "utterances": [
    {"id": "u1", "speaker": "S1", "start": 0, "end": 3, "text": "The pump has three valves.", "asr_confidence": 0.95, "diarization_confidence": 0.9},
    {"id": "u2", "speaker": "S2", "start": 3.5, "end": 6, "text": "Two valves were replaced.", "asr_confidence": 0.4, "diarization_confidence": 0.9},
    {"id": "u3", "speaker": "S1", "start": 5.5, "end": 8, "text": "The gauge has failed.", "asr_confidence": 0.9, "diarization_confidence": 0.8},
    {"id": "u4", "speaker": "S2", "start": 9, "end": 11, "text": "The deck was painted.", "asr_confidence": 0.9, "diarization_confidence": 0.8},
]}
BLOCKS = [
    {"page": 1, "block_no": 0, "text": "Harbour Survey"}, {"page": 1, "block_no": 1, "text": "1. Quay"}, {"page": 1, "block_no": 2, "text": "The quay wall has four\ncracks. It may leak."},
    {"page": 2, "block_no": 0, "text": "Harbour Survey"}, {"page": 2, "block_no": 1, "text": "1.1 Fenders"}, {"page": 2, "block_no": 2, "text": "The fenders were not found."},
]
GOLD = {"claims": [{"evidence_text": "The pump has three valves.", "expected_status": "accepted"}, {"evidence_text": "Two valves were replaced.", "expected_status": "quarantined"}]}


def png(width: int, height: int, rgb: tuple[int, int, int]) -> bytes:
    """A plain PNG of one colour."""
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = (b"\0" + bytes(rgb) * width) * height
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def write_files(folder: str) -> dict[str, str]:
    """The inputs as files below a folder: their paths by modality."""
    root = Path(folder)
    (root / "images").mkdir(parents=True, exist_ok=True)
    (root / "chat.json").write_text(json.dumps(CHAT), encoding="utf-8")
    (root / "audio.json").write_text(json.dumps(AUDIO), encoding="utf-8")
    boxed = [b | {"bbox": [0.0, 0.0, 100.0, 10.0], "extractor": "pymupdf", "risk_flags": []} for b in BLOCKS]
    (root / "blocks.jsonl").write_text("\n".join(map(json.dumps, boxed)), encoding="utf-8")
    for i, color in enumerate(((200, 20, 20), (20, 200, 20))):
        (root / "images" / f"i{i}.png").write_bytes(png(240 + i, 300, color))
    return {"chat": str(root / "chat.json"), "audio": str(root / "audio.json"), "pdf": str(root / "blocks.jsonl"), "image": str(root / "images")}
