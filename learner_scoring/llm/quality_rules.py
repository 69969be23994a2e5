"""Quality rules with host verdicts shrunk by an empirical beta prior.

Rules are counted per document, failures are summed per host (``source``), the
hosts' failure rates are shrunk towards the corpus by a beta prior fitted to
all hosts, and the verdict on a host goes back to its documents.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import arrow_map, cut, raw_texts, ship_by_value, small, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected when its failure rate is surely (by so many posterior standard deviations)
#: above this multiple of the mean host's, or above this rate where the mean is high.
SURE = 2.0
OVER_MEAN = 1.5
MAX_HOST_FAILURE = 0.5
#: Prior weight (documents) with one host or rates spread to both ends, and where the hosts differ by chance alone.
DEFAULT_STRENGTH = 10.0
ALIKE_STRENGTH = 1e9
#: Characters that count as symbols (fixed by the contract).
SYMBOLS = b"#*$%&|<>"

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_NAMES = [f.split()[0] for f in FEATURES.split(", ")]


def text_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated 3-word windows)."""
    words = raw.split()
    chars = len(raw.decode("utf-8", "replace")) - sum(raw.count(c) for c in b" \t\n\x0b\x0c\r")
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, twice = set(), set()
        for w in windows:
            (twice if w in seen else seen).add(w)
        end = 0  # first word not counted yet
        for i, w in enumerate(windows):
            if w in twice:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return len(words), chars, sum(raw.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [text_counts(x) for x in raw_texts(batch)]
    keep = [c for c in batch.schema.names if c != "text"]
    cols = [batch.column(c) for c in keep]
    cols += [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_NAMES))]
    return pa.RecordBatch.from_arrays(cols, names=keep + _NAMES)


def rule_flags(feats: DataFrame) -> DataFrame:
    """Adds ``base_failed`` (hard rules) and ``rule_failed`` (any rule)."""
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    soft = (2 * F.col("n_symbols") > n) | (2 * F.col("n_dup_lines") > n)
    return feats.withColumns({"base_failed": base, "rule_failed": base | soft})


def host_verdicts(flags: DataFrame, host: str = "host") -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate, its sure lower bound, rejected.

    The prior is Beta(m*s, (1-m)*s): m is the mean of the hosts' failure rates
    and s = m(1-m)/v - 1 (method of moments), where v is their variance less
    what chance gives hosts of these sizes at the rate m. A host's posterior is
    the prior with its own documents added; the host is rejected when the
    posterior mean less ``SURE`` standard deviations lies above the bar. So no
    host goes for a few bad documents, nor for being a little above the mean.
    """
    hosts = flags.groupBy(host).agg(
        F.count("*").alias("host_docs"), F.sum(F.col("rule_failed").cast("long")).alias("host_failed")
    )
    n, rate = F.col("host_docs"), F.col("host_failed") / F.col("host_docs")
    # one row, three numbers
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v"), F.avg(1 / n).alias("chance")).first()
    m = prior["m"] or 0.0
    v = None if prior["v"] is None else prior["v"] - m * (1 - m) * prior["chance"]
    if v is None or v >= m * (1 - m) > 0:
        s = DEFAULT_STRENGTH
    else:
        s = m * (1 - m) / v - 1 if v > 0 else ALIKE_STRENGTH
    shrunk = (F.col("host_failed") + F.lit(m * s)) / (n + F.lit(s))
    lower = shrunk - SURE * F.sqrt(shrunk * (1 - shrunk) / (n + F.lit(s + 1)))
    out = hosts.withColumns({"host_rate": shrunk, "host_rate_low": lower})
    return out.withColumn("host_rejected", lower > min(OVER_MEAN * m, MAX_HOST_FAILURE))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: doc_id, host, the counts, the flags and ``kept``.

    Dropped are documents that break a hard rule, and documents of a rejected
    host that break any rule; a document that breaks none always stays, so no
    clean document goes for its neighbours' sake. Null texts count as empty (and
    fail), null hosts are one host, repeated rows are each judged and counted,
    an empty table gives no rows. Only doc_id, text and the host are read, so
    other columns, whatever their names, do no harm.
    """
    narrow = docs.select("doc_id", F.col(host).alias("host"), "text")
    counts = arrow_map(narrow, _features, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, host string, {FEATURES}")
    feats = cut(rule_flags(counts))
    bad = small(cut(host_verdicts(feats).select(F.col("host").alias("h"), "host_rate", "host_rejected")))
    out = feats.join(bad, F.col("host").eqNullSafe(F.col("h")), "left").drop("h")
    return out.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_rejected") & F.col("rule_failed")))


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that :func:`judge` keeps, with all their columns.

    The same verdicts, told on the rows themselves. Texts are counted once: rows
    and flags are written to the shared folder together, without the columns of
    rows that a hard rule rejects; hosts are judged from the flags alone (the
    scan reads no text), and what stays is a filter on the written rows.
    """
    names = docs.columns
    keyed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, src = f"c{names.index('text')}", f"c{names.index(host)}"
    flags = ["base_failed", "rule_failed"]

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, soft = [], []
        for raw in raw_texts(batch, text):
            n, _, sym, dup, rep = text_counts(raw)
            base.append(n < MIN_WORDS or 100 * rep > MAX_REPEAT_PERCENT * n)
            soft.append(base[-1] or 2 * sym > n or 2 * dup > n)
        cols = [pa.array(base, pa.bool_()), pa.array(soft, pa.bool_())]
        return pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *flags])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema) + ", base_failed boolean, rule_failed boolean"
    told = arrow_map(keyed, judged, schema)
    told = told.select(F.col(src).alias("host"), *flags, *[F.when(~F.col("base_failed"), F.col(c)).alias(c) for c in keyed.columns])
    told = written(told)
    hosts = told.select("host", *flags)
    bad = small(cut(host_verdicts(hosts).filter("host_rejected").select(F.col("host").alias("h"), "host_rejected")))
    stays = told.filter("not base_failed").join(bad, F.col("host").eqNullSafe(F.col("h")), "left")
    return stays.filter("host_rejected is null or not rule_failed").select(keyed.columns).toDF(*names)


ship_by_value(__name__)
