"""Mixture-controlled packing of token documents into fixed windows by deficit round-robin.

Every source is a queue of documents.  The corpus is served in rounds ("windows" of
``round_tokens`` tokens, by default one sequence).  In a round each queue gets its quantum, the target share of the round, plus
the deficit it carries; what it is served is the whole number of tokens in that sum, and the rest is
carried on.  Documents may be cut, so a queue is always served its whole quantum, and the state after
``w`` rounds has a closed form: of the ``a`` tokens that a queue has in a phase of ``rounds`` rounds it has been
served ``a * w // rounds``, with a deficit of less than one token.  So every task can tell for itself
where each of its documents falls: deficits carry over windows and partitions without a sequential
pass.  Targets that differ from the corpus' own shares empty some queues early; each such event ends a
phase, and the queues that are left share the next one by their weights.

The rounds in order are one stream of tokens.  Each round is within a token for each source of a sequence, so a full
sequence holds its targets to as many tokens as there are sources.  The stream is cut every ``seq_len`` tokens; what is left at the
end is cut into powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import table, written
from .word_ids import word_ids_of

#: Above so many sources, those without a target share queues by hash, so that the table of queues stays bounded.
MOST_QUEUES = 4096
#: Tokens that a round has for each queue at least, on average, so that documents of many sources are not cut to pieces.
LEAST_SERVED = 16
#: Largest table of (partition, queue) offsets that is broadcast; a larger one is joined by shuffle.
MOST_BROADCAST_ROWS = 200_000

IDS_SCHEMA = "part int, queue string, before long, doc_id long, n long, ids binary"
PIECES_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def token_table(docs: DataFrame, vocabulary: str, end_id: int, queues: int | None, named: tuple[str, ...] = ()) -> DataFrame:
    """Ids of each document with ``end_id`` after them (16 bits each where the vocabulary allows), and the tokens of its queue before it in its partition.

    With ``queues``, sources share that many by hash, except the ``named`` ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, served = word_ids_of(vocabulary), TaskContext.get().partitionId(), {}
        narrow = words.narrow and end_id < 1 << 16
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = []
                for doc_id, text, queue in zip(*(batch.column(k)[at : at + 64].to_pylist() for k in range(3))):
                    ids = words.encode(text) + end
                    n = len(ids) // 4
                    if narrow:
                        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
                    rows.append((part, queue, served.get(queue, 0), doc_id, n, ids))
                    served[queue] = served.get(queue, 0) + n
                kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "queue", "before", "doc_id", "n", "ids"])

    queue = F.coalesce(F.col("source").cast("string"), F.lit(""))
    if queues:
        shared = F.concat(F.lit("\0"), F.pmod(F.xxhash64(queue), F.lit(queues)).cast("string"))
        queue = F.when(queue.isin(*named), queue).otherwise(shared) if named else shared
    return docs.select(F.col("doc_id").cast("long"), F.col("text"), queue.alias("queue")).mapInArrow(run, IDS_SCHEMA)


def phases(totals: dict[str, int], targets: dict[str, float] | None, round_tokens: int) -> list[dict]:
    """Rounds in which the same queues are served: their first token, served tokens of each queue, number of rounds."""
    left = {q: n for q, n in sorted(totals.items()) if n}
    taken, start, out = dict.fromkeys(left, 0), 0, []
    while left:
        if targets is None:
            share = dict(left)
        else:
            weights = {q: Fraction(targets.get(q, 0)).limit_denominator(10**6) for q in left}
            active = {q: w for q, w in weights.items() if w > 0} or {q: Fraction(n) for q, n in left.items()}
            whole = sum(active.values())
            length = min(left[q] * whole / w for q, w in active.items())
            share = {q: min(left[q], int(length * w / whole)) for q, w in active.items()}
            share = {q: n for q, n in share.items() if n} or dict.fromkeys([min(active, key=lambda q: left[q] / active[q])], 1)
        total = sum(share.values())
        out.append({"start": start, "from": {q: taken[q] for q in share}, "share": share, "rounds": max(1, -(-total // round_tokens))})
        start += total
        for q, n in share.items():
            taken[q] += n
            left[q] -= n
        left = {q: n for q, n in left.items() if n}
    return out


class Schedule:
    """Where a token of a queue falls in the stream."""

    def __init__(self, plan: list[dict]):
        self.phases = []
        self.by_queue: dict[str, tuple[list[int], list[int]]] = {}
        for k, p in enumerate(plan):
            order = sorted(p["share"])
            self.phases.append((p["start"], p["rounds"], [p["share"][q] for q in order], {q: i for i, q in enumerate(order)}))
            for q, at in p["from"].items():
                starts, which = self.by_queue.setdefault(q, ([], []))
                starts.append(at)
                which.append(k)
        self.rounds: dict[tuple[int, int], list[int]] = {}

    def _round(self, k: int, w: int) -> list[int]:
        """Stream position at which each queue is served in round ``w`` of phase ``k``."""
        if (k, w) not in self.rounds:
            if len(self.rounds) > 10_000:
                self.rounds.clear()
            start, rounds, share, _ = self.phases[k]
            at, out = start + sum(a * w // rounds for a in share), []
            for a in share:
                out.append(at)
                at += a * (w + 1) // rounds - a * w // rounds
            self.rounds[k, w] = out
        return self.rounds[k, w]

    def runs(self, queue: str, x: int, n: int) -> Iterator[tuple[int, int]]:
        """The tokens ``x .. x + n`` of a queue, as (stream position, length) in order."""
        starts, which = self.by_queue[queue]
        j = bisect_right(starts, x) - 1
        while n:
            k = which[j]
            _, rounds, share, order = self.phases[k]
            i = order[queue]
            a, y = share[i], x - starts[j]
            if y == a:
                j += 1
                continue
            w = y * rounds // a
            while a * (w + 1) // rounds <= y:
                w += 1
            here = min(n, a * (w + 1) // rounds - y)
            yield self._round(k, w)[i] + y - a * w // rounds, here
            x, n = x + here, n - here


def tail_sequences(total: int, seq_len: int) -> list[tuple[int, int]]:
    """First position and length of the sequences after the last full one: powers of two, largest first."""
    at, out = total - total % seq_len, []
    for bit in range((total - at).bit_length() - 1, -1, -1):
        if (total - at) >> bit & 1 and (total % seq_len) >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack(docs: DataFrame, vocabulary: str, *, seq_len: int = 2048, end_id: int = 1, round_sequences: int | None = None, targets: dict[str, float] | None = None, keep_ids: bool = False) -> DataFrame:
    """Pack all documents (``doc_id``, ``text``, ``source``) into sequences; one row per piece.

    A round is one sequence, or, where there are so many queues that they would be served less than LEAST_SERVED tokens each on
    average, as many sequences as that takes; ``round_sequences`` sets it.  ``targets`` weighs the sources (None: their own shares of the corpus, so that all end together).  With more than
    MOST_QUEUES sources, each source in ``targets`` keeps a queue of its own and only the others share queues.
    A null or empty text is its end id alone; a null source is a queue of its own (with ''); a null
    doc_id and repeated rows are packed like any other; an empty table gives no rows; other columns are
    not read.  With ``keep_ids`` the ids of each piece (little-endian unsigned 32-bit) stay in ``ids``.
    """
    spark = docs.sparkSession
    queues = None
    if docs.select("source").distinct().limit(MOST_QUEUES + 1).count() > MOST_QUEUES:
        queues = MOST_QUEUES
    ids = written(token_table(docs, vocabulary, end_id, queues, tuple(targets or ())), "packing-ids")
    sums = ids.groupBy("part", "queue").agg(F.sum("n").alias("n")).persist()
    totals = {r.queue: r.n for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # at most MOST_QUEUES and the targets
    plan = phases(totals, targets, (round_sequences or max(1, -(-LEAST_SERVED * len(totals) // seq_len))) * seq_len)
    total = sum(totals.values())
    full, tail = total - total % seq_len, tail_sequences(total, seq_len)
    earlier = F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = sums.select("part", "queue", F.coalesce(earlier, F.lit(0)).alias("base"))
    if sums.count() <= MOST_BROADCAST_ROWS:
        base = F.broadcast(base)
    placed = ids.join(base, ["part", "queue"]).select("queue", (F.col("base") + F.col("before")).alias("x"), "doc_id", "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(plan)
        kinds = (pa.int64(),) * 7 + (pa.binary(),)
        names = [c.split()[0] for c in PIECES_SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for queue, x, doc_id, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if len(ids) < 4 * n:
                    ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                view, start = memoryview(ids), 0
                for g, length in schedule.runs(queue, x, n):
                    while length:
                        if g < full:
                            seq, offset = divmod(g, seq_len)
                            here = min(length, seq_len - offset)
                        else:
                            k = bisect_right(tail, (g, seq_len)) - 1
                            seq, offset = full // seq_len + k, g - tail[k][0]
                            here = min(length, tail[k][1] - offset)
                        piece = view[4 * start : 4 * (start + here)]
                        rows.append((doc_id, start, here, zlib.crc32(piece), n, seq, offset, bytes(piece) if keep_ids else None))
                        start, g, length = start + here, g + here, length - here
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 8, kinds)], names)

    out = placed.mapInArrow(run, PIECES_SCHEMA)
    return out if keep_ids else out.drop("ids")


def op10_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
