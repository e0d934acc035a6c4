"""Token counts by heap-and-linked-list byte-pair merging, without building identifiers."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unicode White_Space, the class that the tokenizer's own patterns use.
_SPACE = r"\t-\r \x85\xa0  -     　"
_PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Memory bound of a worker: words whose counts are remembered. A full memo is emptied; results don't depend on it.
MEMO_WORDS = 400_000


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if visible Latin-1, else the next free code point from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class HeapBpe:
    """Counts the tokens that a lower-casing word-end BPE vocabulary (a tokenizers .json) gives."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.known = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.alphabet = byte_alphabet()
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words: dict[bytes, int] = {}
        self.pieces: dict[str, int] = {}

    def merged_length(self, symbols: list[str]) -> int:
        """Initial symbols minus merges; the pair of lowest rank, then the leftmost, is always merged next."""
        n = len(symbols)
        if n < 2:
            return n
        rank, after, before = self.rank, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # one side has been merged since
            symbols[i], symbols[j] = a + b, ""
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (r := rank.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return left

    def piece(self, piece: str) -> int:
        if (n := self.pieces.get(piece)) is None:
            chars = [self.alphabet[b] for b in piece.encode("utf-8", "replace")]
            chars[-1] += self.end
            n = self.merged_length([c for c in chars if c in self.known])
            if len(self.pieces) >= MEMO_WORDS:
                self.pieces.clear()
            if len(piece) <= 64:
                self.pieces[piece] = n
        return n

    def plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return sum(map(self.piece, _PIECE.findall(text)))

    def word(self, word: bytes) -> int:
        """Tokens of a run without ASCII white space; no rule of the tokenizer crosses such white space."""
        text = word.decode("utf-8", "replace")
        if self.special is None:
            return self.plain(text)
        cuts = [m.span() for m in self.special.finditer(text)]
        starts, ends = [0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(text)]
        return len(cuts) + sum(self.plain(text[s:e]) for s, e in zip(starts, ends, strict=True) if s < e)

    def count(self, text: bytes) -> int:
        memo, total, missed = self.words, 0, []
        for w in text.split():
            n = memo.get(w)
            if n is None:
                missed.append(w)
            else:
                total += n
        for w in missed:
            n = memo.get(w)
            if n is None:
                n = self.word(w)
                if len(w) <= 64:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[w] = n
            total += n
        return total


_COUNTERS: dict[int, HeapBpe] = {}


def token_counts(docs: DataFrame, vocabulary: str, *, text: str = "text", limit: int = 2048) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit) added.

    vocabulary: the content of a tokenizers .json (a fixed file of a few MB,
    broadcast once). A null or empty text has 0 bytes and 0 tokens. Rows, nulls in
    other columns and repeated rows pass through as they are; input columns named
    like the three results are replaced. A narrow map: no shuffle, and the memory of
    a worker is bounded by MEMO_WORDS and one Arrow batch, whatever the text length.
    """
    spark = docs.sparkSession
    shared, key = spark.sparkContext.broadcast(vocabulary), hash(vocabulary)
    keep = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    schema = docs.select(keep).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    body = text if text in keep else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _COUNTERS.get(key)
        if bpe is None:
            bpe = _COUNTERS[key] = HeapBpe(shared.value)
        for batch in batches:
            texts = (x.as_py() or b"" for x in batch.column(body).cast(pa.binary()))
            found = [(len(x), bpe.count(x)) for x in texts]
            cols = [*batch.columns, pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64()), pa.array([x > limit for _, x in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(keep).mapInArrow(count, schema)


def token_count_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    counted = token_counts(docs.select("doc_id", F.col("text")), vocabulary)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")
