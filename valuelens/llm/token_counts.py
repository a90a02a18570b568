"""Token counts (13): pre-token lengths looked up on the map side in two tiers.

A byte-level BPE never merges over the border of a pre-token, so a text's token count is the
sum of its pre-tokens' lengths. Tier one is a compact table of the most frequent
pre-tokens and their lengths, fitted on a bounded sample, measured, and broadcast; tier two is a
bounded cache in each worker, filled by encoding a missing pre-token once with the library. The
sample only decides what is looked up fast, never a result. No pre-token is ever shuffled.

Pre-tokens are cut with the pattern of the ``regex`` package. The package and the tokenizer library may
carry different Unicode versions, so a worker compares both on every character the first time
it meets it; a text that holds a character on which they differ is cut by the library itself.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.tables import map_arrow

#: Pre-tokens of a byte-level BPE with its usual pattern (a fixed value of that tokenizer kind).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bounds: texts of the sample, characters taken of each, table entries, bytes of an entry.
SAMPLE_TEXTS, SAMPLE_CHARS, TABLE, ENTRY_BYTES = 2000, 4000, 40_000, 48

#: Bounds of a worker: entries of its cache, characters of a cached pre-token, characters cut at a time.
CACHE, CACHED_CHARS, STRETCH = 200_000, 64, 1 << 19


def two_tier(vocabulary: dict) -> bool:
    """Whether counts of this tokenizer are sums over the pre-tokens of ``PATTERN``."""
    pre = vocabulary.get("pre_tokenizer") or {}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in vocabulary.get("added_tokens", []))
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not vocabulary.get("normalizer") and vocabulary["model"]["type"] == "BPE" and not vocabulary["model"].get("ignore_merges") and plain)


class _Lengths(dict):
    """Pre-token -> number of tokens: the table's entries, then the cache, then the library."""

    def __init__(self, known: dict[str, int], encode):
        super().__init__(known)
        self.encode, self.cache = encode, {}

    def __missing__(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            n = self.encode(piece)
            if len(piece) <= CACHED_CHARS:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[piece] = n
        return n


class PieceCounter:
    """Token counts of texts in one process."""

    def __init__(self, vocabulary: str, known: dict[str, int]):
        import regex
        from tokenizers import Tokenizer

        parsed = json.loads(vocabulary)
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_padding()
        self.library.no_truncation()
        self.exact = two_tier(parsed)
        self.find = regex.compile(PATTERN).findall
        self.seam = regex.compile(r"(?<=\S) (?=\S)").search
        special = [t["content"] for t in parsed.get("added_tokens", [])]
        longest_first = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self.lengths = _Lengths(known, lambda piece: len(self.library.encode(piece, add_special_tokens=False)))
        self.same, self.other = set(map(chr, range(128))), set()

    def _library_pieces(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _agree(self, text: str) -> bool:
        """Whether both cut every character of the text alike."""
        if text.isascii():
            return True
        for c in set(text) - self.same:
            if c not in self.other:
                probe = f"a{c}b1{c}2 {c}!{c}?"
                (self.same if self.find(probe) == self._library_pieces(probe) else self.other).add(c)
        return not self.other or self.other.isdisjoint(text)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special strings, a stretch at a time.

        A space between two characters that are none always begins a pre-token: stretches end there.
        """
        find = self.find if self._agree(text) else self._library_pieces
        at = 0
        while len(text) - at > STRETCH:
            seam = self.seam(text, at + STRETCH)
            if seam is None:
                break
            yield find(text[at : seam.start()])
            at = seam.start()
        yield find(text[at:] if at else text)

    def count(self, text: str) -> int:
        if not self.exact:
            return len(self.library.encode(text, add_special_tokens=False))
        n, rest = 0, [text]
        if self.special is not None:
            rest = self.special.split(text)
            n = len(rest) - 1
        return n + sum(sum(map(self.lengths.__getitem__, p)) for part in rest for p in self.pieces(part))


_KEPT: dict[str, PieceCounter] = {}


def _counter(name: str, shared) -> PieceCounter:
    """The process's counter of query ``name``: its tokenizer and cache live as long as the worker serves that query."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = PieceCounter(shared.value[0], _unpacked(*shared.value[1:]))
    return _KEPT[name]


def frequent(docs: DataFrame, vocabulary: str, text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The table: pre-tokens joined as bytes, their ends, and their lengths in tokens.

    Counted over the first SAMPLE_CHARS characters of at most SAMPLE_TEXTS distinct texts drawn by hash; at most
    TABLE entries of at most ENTRY_BYTES bytes, so sample and table have fixed bounds whatever the input.
    """
    one_in = -(-docs.count() // SAMPLE_TEXTS) or 1
    drawn = docs.select(F.substring(text, 1, SAMPLE_CHARS).alias("t")).where(F.col("t").isNotNull() & (F.pmod(F.xxhash64("t"), F.lit(one_in)) == 0))
    counter, seen = PieceCounter(vocabulary, {}), Counter()
    if counter.exact:
        for row in drawn.distinct().limit(SAMPLE_TEXTS).collect():
            for part in counter.special.split(row.t) if counter.special is not None else [row.t]:
                for p in counter.pieces(part):
                    seen.update(p)
    entries = [(p, e) for p, e in ((p, p.encode("utf-8", "replace")) for p, _ in seen.most_common(TABLE)) if len(e) <= ENTRY_BYTES]
    lengths = [len(x) for x in counter.library.encode_batch([p for p, _ in entries], add_special_tokens=False)]
    ends = np.cumsum([len(e) for _, e in entries], dtype=np.int64).astype(np.uint32)
    return b"".join(e for _, e in entries), ends, np.array(lengths, dtype=np.uint8)


def _unpacked(blob: bytes, ends: np.ndarray, lengths: np.ndarray) -> dict[str, int]:
    stops = ends.tolist()
    return {blob[a:b].decode(): n for a, b, n in zip([0, *stops], stops, lengths.tolist())}


def count(docs: DataFrame, vocabulary_path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens (long), over_limit (n_tokens > limit).

    ``vocabulary_path`` is a tokenizer file in the JSON form of the ``tokenizers`` library; the driver reads
    it and workers get its content. Counts are the library's: no begin, end or added special tokens, but a
    special string inside a text is its own token, nothing truncated or padded. A tokenizer that is no
    byte-level BPE of the usual pattern is counted by the library text by text. A null text is
    empty and has no tokens; rows that repeat count each; bytes that are not UTF-8 count as replacement characters;
    an empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = frequent(docs, vocabulary, "text")
    shared, name = docs.sparkSession.sparkContext.broadcast((vocabulary, *table)), uuid.uuid4().hex

    def counted(batches):
        for b in batches:
            counter = _counter(name, shared)
            texts = b.column("text").cast(pa.binary()).to_pylist()
            n = [counter.count(t.decode("utf-8", "replace")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    out = map_arrow(sized, counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
