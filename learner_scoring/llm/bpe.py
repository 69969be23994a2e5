"""Byte-level BPE over overlapping chunks.

A long text is cut into chunks that overlap. Each chunk is pre-tokenised on its
own, from a left edge that may lie inside a pre-token; where the boundaries of
two neighbours first agree inside their overlap they agree from there on (the
pattern looks only ahead), so the text is stitched at that point. Only the
boundaries inside the overlaps meet per text; the pieces between the stitches are
encoded by merge ranks where they lie, in parallel. Decoding concatenates the
tokens' raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learner_scoring.llm.common import bounded_batches, cut, ship_by_value, sliced

#: Code points of a chunk without its overlap, and of the overlap behind it.
CHUNK = 1 << 15
OVERLAP = 1 << 10
#: Pre-tokens whose ids a worker remembers: the first it meets, which are the frequent ones.
CACHE = 1 << 17


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary in rank order; a file of one base64 token and its rank a line.

    The vocabulary's size bounds what is read here and sent to the executors.
    """
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    ranked = sorted((int(r), base64.b64decode(t)) for t, r in rows)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [t for _, t in ranked]


def codec_state(tokens: list[bytes]) -> dict:
    """What a codec keeps, as plain values; sent as a broadcast, so a worker's tasks share the remembered ids."""
    return {"tokens": tokens, "names": [str(i) for i in range(len(tokens))], "rank": {t: i for i, t in enumerate(tokens)}, "cache": {}}


class Codec:
    """Encoder and decoder over one vocabulary; remembers the ids of pre-tokens in its state."""

    def __init__(self, state: dict, pattern: str):
        import regex

        self.tokens, self.names, self.rank, self.cache = (state[k] for k in ("tokens", "names", "rank", "cache"))
        self.pattern = regex.compile(pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is merged, leftmost first, until none is left."""
        rank, none = self.rank, len(self.tokens)
        if piece in rank:
            return [rank[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) > 256:
            return self._merge_long(parts)
        pairs = [rank.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            parts[i : i + 2] = [whole := parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank.get(whole + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank.get(parts[i - 1] + whole, none)
        return [rank[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same for long pre-tokens, with a heap over a linked list."""
        import heapq

        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap: list[tuple[int, int, bytes]] = []

        def push(i: int) -> None:
            j = right[i]
            if j < n and (r := self.rank.get(pair := parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, pair))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or parts[i] + parts[j] != pair:
                continue
            parts[i], alive[j] = pair, False
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                push(left[i])
            push(i)
        return [self.rank[p] for p, a in zip(parts, alive) if a]

    def ids_of(self, pieces: list[str]) -> list[int]:
        cache, out = self.cache, []
        for p in pieces:
            ids = cache.get(p)
            if ids is None:
                ids = self.merge(p.encode())
                if len(cache) < CACHE and len(p) <= 64:
                    cache[p] = ids
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        return self.ids_of(self.pattern.findall(text))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def chunk_starts(n: int, size: int = CHUNK) -> list[int]:
    return list(range(0, max(n, 1), size))


def stitch(codec: Codec, chunks: list[tuple[int, str, list[int]]], at: int = 0) -> Iterator[str]:
    """Pre-tokens of a text, from its boundary ``at`` on, from its chunks: (start, text, boundaries from the start), in order.

    Walks the chunks' boundaries; in an overlap the walk goes over to the next
    chunk at the first boundary both have. Where an overlap has none (a pre-token
    longer than it), the next chunk's text is pre-tokenised again from the last
    sure boundary, with as many further chunks as that takes.
    """
    k = 0
    while k < len(chunks):
        start, text, bounds = chunks[k]
        if k + 1 == len(chunks):
            marks = [b for b in bounds if b + start >= at]
            yield from (text[i:j] for i, j in zip(marks, marks[1:]))
            return
        nxt, _, nxt_bounds = chunks[k + 1]
        theirs = {b + nxt for b in nxt_bounds}
        # the last boundary of a chunk that is cut off on the right isn't sure, nor is the one before it
        sure = [b for b in bounds[:-2] if b + start >= at]
        meet = next((b for b in sure if b + start >= nxt and b + start in theirs), None)
        if meet is not None:
            marks = [b for b in sure if b <= meet]
            yield from (text[i:j] for i, j in zip(marks, marks[1:]))
            at, k = meet + start, k + 1
            continue
        # no meeting point: join this chunk's rest and the next chunk, and look again
        offset = at - start
        joined = text[offset : nxt - start] + chunks[k + 1][1]
        chunks[k + 1] = (at, joined, [m.start() for m in codec.pattern.finditer(joined)] + [len(joined)])
        k += 1


def _digest(codec: Codec, ids: list[int]) -> tuple[int, str, str]:
    names = ",".join([codec.names[i] for i in ids])
    return len(ids), hashlib.sha256(names.encode()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()


def encoded(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row of ``docs``.

    Texts up to ``chunk`` code points are encoded where they are read. Longer
    ones are cut; the chunks are dealt out and pre-tokenised apart, the stitches
    are found from the boundaries inside the overlaps, every chunk encodes what
    lies between its two stitches, and only the ids come together per text. From
    an overlap without a common boundary on (a pre-token longer than it), the
    rest of that text is stitched in one task. Null texts count as empty (no
    tokens); equal rows give equal rows; a null doc_id stays null. ``keep_ids``
    adds the ids themselves.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec_state(read_ranks(vocabulary)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"
    narrow = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for b in sliced(batches, 1 << 20):
            ids = [codec.encode(t) for t in b.column("text").to_pylist()]
            yield result(b.column("doc_id"), codec, ids)

    def result(doc_ids: pa.Array, codec: Codec, ids: list[list[int]]) -> pa.RecordBatch:
        n, a, d = zip(*(_digest(codec, x) for x in ids))
        cols = [doc_ids, pa.array(n, pa.int64()), pa.array(a), pa.array(d)]
        cols.append(pa.array(ids if keep_ids else [None] * len(ids), pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    short = narrow.filter(F.length("text") <= chunk).mapInArrow(whole, out)

    # equal long rows are encoded once; ``copies`` brings them back
    long = narrow.filter(F.length("text") > chunk).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    named = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    long = long.withColumn("key", F.concat(F.sha2("text", 256), named))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            for doc, text, copies, key in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "copies", "key"))):
                starts = chunk_starts(len(text), chunk)
                parts = [text[s : s + chunk + overlap] for s in starts]
                same = len(starts)
                cols = [pa.array([doc] * same, b.column("doc_id").type), pa.array([key] * same), pa.array([copies] * same, pa.int64())]
                cols += [pa.array(starts, pa.int64()), pa.array(parts)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "copies", "start", "part"])

    head = f"doc_id {kind}, key string, copies long, start long, part string"
    chunks = long.mapInArrow(cut_up, head).repartition("key", "start")

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds each chunk's boundaries, and those that it shares its first and last code points with its neighbours."""
        find = Codec(shared.value, pattern).pattern.finditer
        ints = pa.list_(pa.int64())
        for b in sliced(batches):
            parts, starts = (b.column(c).to_pylist() for c in ("part", "start"))
            bounds = [[m.start() for m in find(p)] + [len(p)] for p in parts]
            first = [[s + x for x in xs if x <= overlap] for s, xs in zip(starts, bounds)]
            # the last boundary of a chunk that is cut off on the right isn't sure, nor is the one before it
            last = [[s + x for x in xs[:-2] if x >= chunk] for s, xs in zip(starts, bounds)]
            cols = [pa.array(bounds, pa.list_(pa.int32())), pa.array(first, ints), pa.array(last, ints)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, "bounds", "first", "last"])

    told = cut(chunks.mapInArrow(pretokenise, head + ", bounds array<int>, first array<long>, last array<long>"))

    # a chunk's stitches: with the chunk before (``from``) and the next one (``to``, null at the end of the text)
    text = Window.partitionBy("key").orderBy("start")
    theirs = F.lead("first").over(text)
    meets = told.select("key", "start", theirs.isNotNull().alias("more"), F.array_min(F.array_intersect("last", theirs)).alias("to"))
    meets = meets.withColumn("from", F.coalesce(F.lag("to").over(text), F.lit(0)))
    lost = F.col("more") & (F.col("to").isNull() | (F.col("to") < F.col("from")))
    meets = meets.withColumn("rest", F.min(F.when(lost, F.col("start"))).over(text.rowsBetween(Window.unboundedPreceding, 0)))
    placed = told.drop("first", "last").join(meets.drop("more"), ["key", "start"])

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for b in sliced(batches):
            ids = []
            for start, part, bounds, lo, hi in zip(*(b.column(c).to_pylist() for c in ("start", "part", "bounds", "from", "to"))):
                marks = [x for x in bounds if x + start >= lo and (hi is None or x + start <= hi)]
                ids.append(codec.ids_of([part[i:j] for i, j in zip(marks, marks[1:])]))
            cols = [b.column(c) for c in ("doc_id", "key", "copies", "start")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "key", "copies", "start", "ids"])

    def encode_rest(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("start")
        codec = Codec(shared.value, pattern)
        parts = list(zip(*(rows.column(c).to_pylist() for c in ("start", "part", "bounds"))))
        ids: list[int] = []
        for piece in stitch(codec, parts, rows.column("from")[0].as_py()):
            ids += codec.ids_of([piece])
        one = rows.select(["doc_id", "key", "copies", "start"]).slice(0, 1)
        return one.append_column("ids", pa.array([ids], pa.list_(pa.int32())))

    def join_up(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("start")
        ids = rows.column("ids").combine_chunks().flatten().to_pylist()
        done = result(rows.column("doc_id").combine_chunks().slice(0, 1), Codec(shared.value, pattern), [ids])
        return pa.Table.from_batches([done]).append_column("copies", rows.column("copies").slice(0, 1))

    encoded_head = f"doc_id {kind}, key string, copies long, start long, ids array<int>"
    pieces = placed.filter("rest is null").mapInArrow(encode_pieces, encoded_head)
    rest = placed.filter("rest is not null").groupBy("key").applyInArrow(encode_rest, encoded_head)
    joined = pieces.unionByName(rest).groupBy("key").applyInArrow(join_up, out + ", copies long")
    again = joined.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_i", "copies")
    both = short.unionByName(again)
    return both if keep_ids else both.drop("ids")


ship_by_value(__name__)
