"""Substring dedup with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of a document. The smallest hash among
a window's k-grams depends on the window's words alone, so equal windows share
it; consecutive windows of a document that share it form a segment. Segments
whose k-gram occurs once are done with; those that all equal each other are
repeated as a whole; the others are dealt to shards by their k-gram. Each shard indexes its
distinct segments and streams them through backward search, which gives the
matching statistics up to the window's length; intervals that reach it at a
second place are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import arrow_map, bounded_batches, cut, raw_texts, ship_by_value, sliced, text_key
from learner_scoring.llm.fm_index import FMIndex, match_counts

WINDOW = 35
#: Words of the k-grams that choose a window's shard.
GRAM = 8
#: Words that a task indexes at a time.
BLOCK_WORDS = 1 << 20
#: A k-gram with more segments than this is spread over several shards by window.
HOT = 1 << 15

_B = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_B_INV = pow(_B, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of rolling sums (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbouring words."""
    n = len(h) - k + 1
    out = h[:n]
    for j in range(1, k):
        out = out * np.uint64(_B) + h[j : j + n]
    return _mix(out)


_powers: list[np.ndarray] = []


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to the n-th, remembered by the task."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 12)
        _powers[:] = [np.full(size, b, np.uint64) for b in (_B, _B_INV)]
        for p in _powers:
            p[0] = 1
            np.cumprod(p, out=p)
    return _powers[0], _powers[1]


class Rolling:
    """Hashes of word ranges from prefix sums: equal for equal words, wherever they stand."""

    def __init__(self, h: np.ndarray):
        up, self.down = _powers_to(len(h))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def smallest_gram(low: np.ndarray, need: int) -> np.ndarray:
    """Minimum of every ``need`` neighbouring k-gram hashes: one for each window start."""
    span = 1
    while 2 * span <= need:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = need - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def segments(words: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """(start, windows, k-gram, content hash, own) of a text's segments; empty below a window.

    ``own``: the k-gram stands twice in the segment, so windows may repeat inside it.
    """
    n = len(words)
    if n < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
    h = word_hashes(words)
    roll, grams = Rolling(h), gram_hashes(h, gram)
    low = smallest_gram(grams, window - gram + 1)
    start = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    end = np.concatenate([start[1:], [len(low)]])
    own = np.zeros(len(start), bool)
    order = np.argsort(grams, kind="stable")
    if (grams[order][1:] == grams[order][:-1]).any():
        keys, places = grams[order], low[start]
        last = end + window - gram  # end of the segment's k-gram starts
        first = np.searchsorted(keys, places, "left")
        until = np.searchsorted(keys, places, "right")
        for i in np.flatnonzero(until - first > 1):
            own[i] = ((order[first[i] : until[i]] >= start[i]) & (order[first[i] : until[i]] < last[i])).sum() > 1
    return start, end - start, low[start], roll.of(start, end + window - 1), own


def _packed(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 32) | n.astype(np.int64)


def _segment_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[bytes, int] = {}  # a text's second copy proves repetition; a task has no need of a third
        for b in sliced(batches):
            key: list[bytes] = []
            cols: list[list[np.ndarray]] = [[], [], [], []]
            for k, raw in zip(b.column("k").to_pylist(), raw_texts(b)):
                copies[k] = copies.get(k, 0) + 1
                if copies[k] > 2:
                    continue
                start, n, low, seg, own = segments(raw.split(), window, gram)
                key += [k] * len(start)
                for c, x in zip(cols, (_packed(start, n), low.view(np.int64), seg.view(np.int64), own)):
                    c.append(x)
            if key:
                arrays = [pa.array(key, pa.binary()), *(pa.array(np.concatenate(c)) for c in cols)]
                yield pa.RecordBatch.from_arrays(arrays, names=["k", "pos", "gram", "seg", "own"])

    return run


def _piece_rows(window: int):
    """Texts with the segments asked of them -> (gram, part, seg, off, repeated, words).

    Copies of a text stand next to each other; one is enough. Segments of a hot
    k-gram are cut into runs of windows, dealt by the windows' own hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in sliced(batches):
            rows: list[tuple] = []
            for k, raw, asked in zip(b.column("k").to_pylist(), raw_texts(b), b.column("asked").to_pylist()):
                if k == last:
                    continue
                last, words = k, raw.split()
                for a in asked:
                    start, n = a["pos"] >> 32, a["pos"] & 0xFFFFFFFF
                    cuts, parts = np.array([0, n]), np.zeros(1, np.int64)
                    if a["parts"] > 1:
                        roll, at = Rolling(word_hashes(words[start : start + n + window - 1])), np.arange(n)
                        part = (roll.of(at, at + window) % np.uint64(a["parts"])).astype(np.int64)
                        edge = np.flatnonzero(np.diff(part)) + 1
                        cuts = np.concatenate([[0], edge, [n]])
                        parts = part[cuts[:-1]]
                    for i, j, p in zip(cuts[:-1].tolist(), cuts[1:].tolist(), parts.tolist()):
                        piece = b" ".join(words[start + i : start + j + window - 1])
                        rows.append((a["gram"], p, a["seg"], i, a["repeated"], piece))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=["gram", "part", "seg", "off", "repeated", "words"])

    return run


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


def index_block(pieces: list[tuple], window: int) -> list[tuple[int, int, int, int]]:
    """(gram, seg, first window, windows) of the intervals that occur elsewhere in the block."""
    texts = [p[5].split(b" ") for p in pieces]
    flat = [w for t in texts for w in (*t, b"")]  # no word is empty: the separator
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64) + 1
    sep = coded.dictionary.to_pylist().index(b"") + 1
    ids[ids == sep], ids[ids > sep] = 0, ids[ids > sep] - 1
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths + 1) - 1
    index = FMIndex(ids, window)
    counts = match_counts(index, ids, ends, lengths - window + 1, window)
    out = []
    for (gram, _, seg, off, repeated, _), n in zip(pieces, counts):
        flags = np.ones(len(n), bool) if repeated else n > 1
        out += [(gram, seg, off + a, m) for a, m in _runs(flags)]
    return out


def _index_rows(window: int, block_words: int):
    """Rows sorted by shard; whole shards are gathered into blocks and indexed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, shard = 0, None

        def flush():
            found = index_block(held, window)
            cols = [pa.array(c, pa.int64()) for c in (zip(*found) if found else ([],) * 4)]
            return pa.RecordBatch.from_arrays(cols, names=["gram", "seg", "first", "n"])

        for b in sliced(batches):
            for row in zip(*(b.column(c).to_pylist() for c in ("gram", "part", "seg", "off", "repeated", "words"))):
                if row[:2] != shard and size >= block_words:
                    yield flush()
                    held, size = [], 0
                shard = row[:2]
                held.append(row)
                size += row[5].count(b" ") + 2
        if held:
            yield flush()

    return run


def repeated_windows(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS, hot: int = HOT) -> DataFrame:
    """(k, start, n): runs of window starts whose words also start elsewhere, by text key.

    ``keyed`` has (doc_id, k, text); k identifies the text.
    """
    bounded_batches(keyed.sparkSession)
    segs = keyed.select("k", "text").mapInArrow(_segment_rows(window, gram), "k binary, pos long, gram long, seg long, own boolean")
    counts = segs.groupBy("gram").agg(F.count("*").alias("c"), F.min("seg").alias("a"), F.max("seg").alias("b"), F.max("own").alias("o"))
    twice = counts.filter("c > 1 or o").select("gram", "c", F.expr("a = b and not o").alias("same"))
    dup = cut(segs.drop("own").join(twice, "gram"))
    pos = lambda c: (F.shiftright(c, 32).alias("start"), F.col(c).bitwiseAND(0xFFFFFFFF).alias("n"))
    whole = dup.filter("same").select("k", *pos("pos"))

    mixed = dup.filter("not same")
    reps = mixed.groupBy("gram", "seg").agg(
        F.min(F.struct("k", "pos")).alias("rep"), (F.count("*") > 1).alias("repeated"), F.max("c").alias("c")
    )
    parts = F.ceil(F.col("c") / hot).alias("parts")
    asked = reps.select("rep.k", "rep.pos", "gram", "seg", "repeated", parts).groupBy("k").agg(
        F.collect_list(F.struct("pos", "gram", "seg", "repeated", "parts")).alias("asked")
    )
    pieces = keyed.join(asked, "k").select("doc_id", "k", "text", "asked").mapInArrow(
        _piece_rows(window), "gram long, part long, seg long, off long, repeated boolean, words binary"
    )
    dealt = pieces.repartition("gram", "part").sortWithinPartitions("gram", "part")
    found = dealt.mapInArrow(_index_rows(window, block_words), "gram long, seg long, first long, n long")
    marks = mixed.join(found, ["gram", "seg"]).select("k", (F.shiftright("pos", 32) + F.col("first")).alias("start"), "n")
    return whole.unionByName(marks)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """(doc_id, n_words, n_removed, text) per document: its words without those of repeated windows.

    Windows are judged on the input: where a passage occurs twice, both go.
    Kept words are joined by one space. Null and empty texts have no words and
    come out empty; texts below a window stay whole; repeated rows repeat each
    other; an empty table gives no rows. Other columns are not read.
    """
    keyed = docs.select("doc_id", text_key().alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    runs = repeated_windows(keyed, window, **sizes)
    per_text = runs.groupBy("k").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    joined = keyed.join(per_text, "k", "left").select("doc_id", "k", "text", "runs")

    def remove(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for raw, runs in zip(raw_texts(b), b.column("runs").to_pylist()):
            words = raw.split()
            gone = np.zeros(len(words), bool)
            for r in runs or ():
                gone[r["start"] : r["start"] + r["n"] + window - 1] = True
            kept = [w for w, g in zip(words, gone.tolist()) if not g] if runs else words
            rows.append((len(words), len(words) - len(kept), b" ".join(kept)))
        n, m, text = zip(*rows)
        cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_removed", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(joined, remove, f"doc_id {kind}, n_words long, n_removed long, text string")


ship_by_value(__name__)
