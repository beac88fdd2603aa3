"""Byte-pair encoding as a bounded-lookahead streaming transducer, and its incremental decoder.

The merge list of a byte-level vocabulary fixes how far to the right of a cut a merge can still
change what stands left of it.  ``MergeTable.lookahead`` computes that bound once:

    Run the merges rule by rule, in rank order, over a text cut after ``n`` bytes and over the whole
    text.  Let ``d`` be the last position up to which both runs agree (at first the cut).  A rule
    ``(u, v)`` moves ``d`` only by joining the last agreed token, which is ``u``, to what stands right
    of it, so ``d`` falls by ``len(u)``.  The token right of the new ``d`` then starts with ``u`` in
    both runs, so the next rule that moves ``d`` has a later rank and a right part with ``u`` on its
    left spine.  The longest such chain, weighted by ``len(u)``, is a sufficient lookahead.

``encode_run`` therefore merges a window, emits the tokens that end at least ``lookahead`` bytes
before its end, and goes on from the last emitted boundary: memory is one window, whatever the length
of the run.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import table, worker_cache

#: The split pattern of the byte-level vocabulary (with Unicode White_Space for \s).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space between two other characters always starts a piece, so a text may be cut before it.
SAFE_CUT = regex.compile(r"(?<=\S) (?=\S)")
CHUNK_CHARS = 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Ranks, token bytes and the sufficient lookahead of a byte-level merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.token_bytes = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in vocab.items():
            self.token_bytes[i] = token.encode() if token in self.special else bytes(map(alphabet.__getitem__, token))
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = [0] * 256
        for char, b in alphabet.items():
            self.byte_id[b] = vocab[char]
        self.rules: list[tuple[int, int, int]] = []
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rules.append((vocab[left], vocab[right], vocab[left + right]))
        self.rank = {(u, v): rank for rank, (u, v, _) in enumerate(self.rules)}
        self.lookahead = self._lookahead()
        longest = max(map(len, self.token_bytes))
        self.window = max(4096, 4 * (self.lookahead + longest))
        self.split = regex.compile(SPLIT)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces = PieceCache(self)

    def _lookahead(self) -> int:
        """The heaviest chain of rules by which what follows a cut can reach back over it, in bytes."""
        first_part: dict[int, int] = {}
        for u, _, new in self.rules:
            first_part.setdefault(new, u)
        reach: dict[int, int] = {}  # by left part: the heaviest chain that ends in an earlier rule
        most = 0
        for u, v, _ in self.rules:
            before, t = 0, v
            while t is not None:
                before = max(before, reach.get(t, 0))
                t = first_part.get(t)
            here = before + len(self.token_bytes[u])
            reach[u] = max(reach.get(u, 0), here)
            most = max(most, here)
        return most

    def merge_window(self, data: bytes) -> list[int]:
        """Merge all of ``data``: lowest rank first, leftmost first."""
        ids = [self.byte_id[b] for b in data]
        if len(ids) <= 256:
            return self._merge_short(ids)
        rank_of = self.rank
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank_of[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i, u, v = heapq.heappop(heap)
            j = after[i] if ids[i] == u else n
            if j >= n or ids[j] != v:
                continue
            ids[i], ids[j] = self.rules[rank][2], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (ids[i], ids[k]) in rank_of:
                    heapq.heappush(heap, (rank_of[ids[i], ids[k]], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (ids[h], ids[i]) in rank_of:
                heapq.heappush(heap, (rank_of[ids[h], ids[i]], h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, rules, none = self.rank, self.rules, len(self.rules)
        ranks = [rank_of.get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i] = new = rules[best][2]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of.get((ids[i - 1], new), none)
            if i < len(ranks):
                ranks[i] = rank_of.get((new, ids[i + 1]), none)
        return ids

    def encode_run(self, data: bytes) -> Iterator[list[int]]:
        """Tokens of one piece, in lists, each emitted once nothing to its right can change it."""
        at = 0
        while len(data) - at > self.window:
            sure, end = [], 0
            for t in self.merge_window(data[at : at + self.window]):
                if end + len(self.token_bytes[t]) > self.window - self.lookahead:
                    break
                end += len(self.token_bytes[t])
                sure.append(t)
            yield sure
            at += end
        if at < len(data):
            yield self.merge_window(data[at:])

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text as little-endian unsigned 32-bit integers, in bounded blocks."""
        for k, part in enumerate(self.special_split.split(text) if self.special_split else [text]):
            if k % 2:
                yield struct.pack("<I", self.special[part])
                continue
            at = 0
            while at < len(part):
                cut = SAFE_CUT.search(part, at + CHUNK_CHARS) if len(part) - at > 2 * CHUNK_CHARS else None
                end = cut.start() if cut else len(part)
                found = self.split.findall(part, at, end)
                if max(map(len, found)) > 256:
                    for piece in found:
                        if len(piece) > 256:
                            for ids in self.encode_run(piece.encode()):
                                yield struct.pack(f"<{len(ids)}I", *ids)
                        else:
                            yield self.pieces[piece]
                else:
                    yield b"".join(map(self.pieces.__getitem__, found))
                at = end


class PieceCache(dict):
    """Encoded short pieces; emptied when their bytes and ids reach ``most_bytes``, about 200 bytes an entry besides."""

    def __init__(self, merges: MergeTable, most_bytes: int = 64_000_000):
        self.merges, self.most_bytes, self.held = merges, most_bytes, 0

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        ids = self.merges.merge_window(data)
        out = struct.pack(f"<{len(ids)}I", *ids)
        self.held += 200 + len(data) + len(out)
        if self.held >= self.most_bytes:
            self.clear()
            self.held = 200 + len(data) + len(out)
        self[piece] = out
        return out


class ByteToText:
    """Incremental decoder: token bytes go in, text comes out as soon as its characters are whole.

    The state is at most three pending bytes; bytes that are no UTF-8 give U+FFFD.
    """

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes = token_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.token_bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def merges_of(path: str) -> MergeTable:
    cache = worker_cache()
    if ("merges", path) not in cache:
        cache["merges", path] = MergeTable(path)
    return cache["merges", path]


def digest_row(merges: MergeTable, text: str | None) -> tuple[int, str, str]:
    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    decoder = ByteToText(merges.token_bytes)
    for block in merges.encode(text or ""):
        n += len(block) // 4
        ids_hash.update(block)
        text_hash.update(decoder.feed(memoryview(block).cast("I")).encode())
    text_hash.update(decoder.finish().encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text; one row per input row, without a shuffle.

    A null or empty text has 0 tokens and the digests of nothing; repeated rows stay repeated; columns
    other than ``id_col`` and ``text_col`` are not read.  The bytes of each block go straight into the
    running digests, so a long text needs no memory beyond itself and one window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(vocabulary)
        for batch in batches:
            rows = [digest_row(merges, t.as_py()) for t in batch.column(1)]
            n, ids, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
