"""Token counts with a whole-token shortcut, and the token ids of texts.

A text is cut at blanks and line feeds. That is safe for tokenizers that drop
white space: no token, normalisation or special string reaches across it
(:func:`load` refuses others). Offline, on the driver, every vocabulary string
is encoded alone: those that come back as one token, themselves, form the
whole-token table (at most the vocabulary's size; broadcast). In the job a
pre-token in that table counts 1 without any merge; only the rest is merged.
Each worker remembers results in a dictionary of bounded size.

Defined results: null and empty texts and texts of white space have 0 tokens;
special strings inside texts are handled as the library does by default;
nothing is added, cut or padded; repeated rows give equal rows; an empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import regex
from tokenizers import Tokenizer

#: Chunks a worker remembers, and a third as many merged pre-tokens (about 200 bytes each).
REMEMBERED = 600_000


#: Byte-level alphabet: control characters, blank, U+007F..U+00A0 and U+00AD move to U+0100 and on.
_BYTE_LEVEL = {b: chr(256 + i) for i, b in enumerate([*range(33), *range(127, 161), 173])}


@dataclass
class Vocabulary:
    """A tokenizer file's content, its special strings and its proven whole tokens."""

    content: str
    special: list[str]
    whole: dict[str, int]          # pre-token as the model sees it -> id
    pattern: str                   # of the pre-tokens
    merges: int = REMEMBERED // 3  # merged pre-tokens remembered
    _loaded: dict = field(default_factory=dict)

    def __getstate__(self):
        return {"content": self.content, "special": self.special, "whole": self.whole, "pattern": self.pattern,
                "merges": self.merges, "_loaded": {}}

    @property
    def tokenizer(self) -> Tokenizer:
        if "t" not in self._loaded:
            self._loaded["t"] = Tokenizer.from_str(self.content)
        return self._loaded["t"]

    def pre_tokens(self, chunk: str) -> list[str]:
        """The chunk's pre-tokens as the model sees them. For printable characters up to U+00FF
        lower-casing and composition are plain: a word, or a word and one mark, is cut by
        hand and the rest by the file's own pattern. Everything else goes through the
        library's normaliser."""
        plain = chunk.isascii()
        if plain or max(chunk) <= "\xff":
            if chunk.isalpha():
                found = [chunk.lower()]
            elif chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
                found = [chunk[:-1].lower(), chunk[-1]]
            elif chunk.isprintable():
                if "p" not in self._loaded:
                    self._loaded["p"] = regex.compile(self.pattern)
                found = self._loaded["p"].findall(chunk.lower())
            else:
                found = None
            if found is not None:
                return found if plain else [p.encode().decode("latin-1").translate(_BYTE_LEVEL) for p in found]
        t = self.tokenizer
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(chunk))]

    def merged(self, piece: str) -> bytes:
        """Ids of a pre-token that is no whole token, little-endian."""
        if "m" not in self._loaded:
            tokenize = self.tokenizer.model.tokenize
            self._loaded["m"] = Remembered(lambda p: _packed([t.id for t in tokenize(p)]), self.merges)
        return self._loaded["m"][piece]

    def count(self, chunk: str) -> int:
        """Tokens of a chunk without blanks."""
        if any(s in chunk for s in self.special):
            return len(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return sum(1 if p in self.whole else len(self.merged(p)) // 4 for p in self.pre_tokens(chunk))

    def ids(self, chunk: str) -> bytes:
        """Token ids of a chunk without blanks, as little-endian unsigned 32-bit numbers."""
        if any(s in chunk for s in self.special):
            return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        whole = self.whole
        return b"".join([_packed([whole[p]]) if p in whole else self.merged(p) for p in self.pre_tokens(chunk)])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Remembered(dict):
    """A function's results by chunk, at most ``most`` of them: when the younger half
    is full it becomes the older one, and what is not asked for again is
    forgotten with the next change."""

    def __init__(self, of, most: int = REMEMBERED):
        super().__init__()
        self.of, self.half, self.old = of, max(1, most // 2), {}

    def __missing__(self, chunk: str):
        found = self.old.get(chunk)
        if found is None:
            found = self.of(chunk)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[chunk] = found
        return found


def _check_cut(vocabulary: Vocabulary) -> None:
    """Refuse a file whose words and marks are cut otherwise than by hand: every character up to
    U+00FF and every pair of them must come out as the library has it."""
    t = vocabulary.tokenizer
    plain = [c for c in map(chr, range(256)) if c.isprintable() and not c.isspace()]
    for chunk in [*plain, *(a + b for a in plain for b in plain)]:
        if vocabulary.pre_tokens(chunk) != [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(chunk))]:
            raise ValueError(f"this tokenizer cuts {chunk!r} in another way")


def load(path: str) -> Vocabulary:
    """Read a ``tokenizers`` file and prove its whole tokens. Files with another normaliser than
    NFC, blanks and lower case, or other steps than one split and bytes, are refused."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    spec = json.loads(content)
    splits = [x for x in spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]]) if x["type"] == "Split"]
    drops = any(x["behavior"] == "Removed" and x["invert"] and r"[^\s" in x["pattern"].get("Regex", "") for x in splits)
    spaces = [a for a in spec["added_tokens"] if a["lstrip"] or a["rstrip"] or a["content"] != "".join(a["content"].split())]
    if not drops or spaces or spec["post_processor"]:
        raise ValueError("texts can be cut at blanks only for tokenizers that drop white space")
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if steps != [{"type": "NFC"}, blanks, {"type": "Lowercase"}]:
        raise ValueError("the normaliser must be NFC, white space to blanks, lower case")
    cut = [x["type"] for x in spec["pre_tokenizer"].get("pretokenizers", [])]
    last = (spec["pre_tokenizer"].get("pretokenizers") or [{}])[-1]
    if cut != ["Split", "ByteLevel"] or last["add_prefix_space"] or last["use_regex"]:
        raise ValueError("pre-tokens must come from one split, then plain bytes")
    if spec["model"].get("dropout"):
        raise ValueError("merges must not be dropped at random")
    t = Tokenizer.from_str(content)
    special = [a["content"] for a in spec["added_tokens"]]
    end = spec["model"]["end_of_word_suffix"] or ""
    whole = {}
    for token, number in t.get_vocab(with_added_tokens=False).items():
        if token.endswith(end):
            alone = token[:len(token) - len(end)] if end else token
            if alone and [x.id for x in t.model.tokenize(alone)] == [number]:
                whole[alone] = number
    vocabulary = Vocabulary(content, special, whole, splits[0]["pattern"]["Regex"])
    _check_cut(vocabulary)
    return vocabulary


def chunks(text: str | None) -> list[str]:
    return (text or "").replace("\n", " ").split(" ")


_WORKER: dict = {}


def remembered(shared, kind: str, most: int = REMEMBERED) -> Remembered:
    """This worker's dictionary for a broadcast vocabulary."""
    key = (kind, most, shared.value.content[:200], len(shared.value.content))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Remembered(getattr(shared.value, kind), most)
    return _WORKER[key]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered(shared, "count")
        for batch in batches:
            n = [sum(map(known.__getitem__, chunks(t.as_py()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")


def op1(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    return count_tokens(docs, load(path)).withColumn("over_limit", F.col("n_tokens") > limit)
