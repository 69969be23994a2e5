"""Secret scans with multipart credential linking; DataFrame functions only.

Strong spans (assignments, access identifiers, long hex runs) are reported where
they stand. Weak parts of a credential (a user name, an e-mail address, a mixed
token, a short assigned value, a private key's header, an endpoint) say nothing
alone: they are reported where an identifier (name, address, access identifier)
and a secret (mixed token, any assignment, long hex run, key header) stand within
one scope, found by an interval join of the parts. A scope is a block of lines
without a blank one, and no more than ``SCOPE`` code points. A connection string
with user and password has its parts in itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Kinds in the order of reports: (name, pattern, words of which a text must hold one, least length).
#: The first three patterns and lengths are fixed by the contract.
VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
STRONG = [
    ("assign", ASSIGN + VALUE, ["passw", "secret", "token", "api"]),
    ("access", r"AKIA[A-Z0-9]+", ["akia"]),
    ("hex", r"[0-9a-f]{32,}", []),
]
USER = r"(?i:user(?:_?name)?|login|account|client_?id)[\"']?\x20*[:=]\x20*[\"']?"
#: User and password in a connection string.
USERINFO = r"[^\x20\x09-\x0D:@/]{1,64}:[^\x20\x09-\x0D@/]{1,128}@"
SCHEME = r"(?:https?|ftp|jdbc:[a-z]+|mongodb|postgres(?:ql)?|mysql|redis|amqp)://"
WEAK = [
    ("user", USER + r"[A-Za-z0-9@._-]{3,}", ["user", "login", "account", "client"]),
    ("mixed", r"[A-Za-z0-9+/]{20,}", []),
    ("endpoint", SCHEME + f"(?:{USERINFO})?" + r"[A-Za-z0-9.-]+(?::[0-9]+)?", ["://"]),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,63}", ["@"]),
    ("key_block", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", ["private key"]),
]
#: Kinds told from a match of another: an assignment whose value is too short, an endpoint with user and password.
KINDS = [k for k, _, _ in STRONG + WEAK] + ["short", "connection"]
SHORT, CONNECTION = len(KINDS) - 2, len(KINDS) - 1
#: A blank line, the border of scopes; no span of its own.
BREAK = len(KINDS)
BLANK = r"\n[\x20\t\r]*\n"
#: Kinds that are the secret of a credential, and those that say whose it is.
SECRETS = tuple(KINDS.index(k) for k in ("assign", "hex", "mixed", "key_block", "short"))
IDENTIFIERS = tuple(KINDS.index(k) for k in ("access", "user", "email"))
#: Group 2 of an assignment and a whole access identifier have at least so many characters.
LEAST_VALUE, LEAST_ACCESS = 8, 16
#: Parts of one credential lie at most so many code points apart, with no blank line between them.
SCOPE = 200


def _holds(lowered: Column, words: list[str]) -> Column:
    out = F.lit(not words)
    for w in words:
        out = out | F.contains(lowered, F.lit(w))
    return out


def _matches(text: Column, kind: int, pattern: str) -> Column:
    r"""Array of (kind, gap, match) of a pattern's matches, leftmost first.

    ``\G`` holds each search at the end of the last match, so the gaps before the
    matches come with them and give the positions; a text is gone over once.
    """
    whole = rf"\G((?s:.*?))({pattern})"
    gaps = F.regexp_extract_all(text, F.lit(whole), F.lit(1))
    found = F.regexp_extract_all(text, F.lit(whole), F.lit(2))
    return F.zip_with(gaps, found, lambda g, m: F.struct(F.lit(kind).alias("kind"), F.length(g).alias("gap"), m.alias("match")))


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))), 256))


def strong_flag(text: Column) -> Column:
    """A cheap test that every text with a strong span, an identifier or a connection string passes."""
    low = F.lower(text)
    named = _holds(low, [w for _, _, words in STRONG[:2] + WEAK[:1] for w in words] + ["@"])
    return named | F.rlike(text, F.lit(STRONG[2][1]))


def part_spans(docs: DataFrame) -> DataFrame:
    """(row, kind, start, end, match): all parts, strong and weak, and blank lines of the texts that hold any strong one or identifier.

    Positions are code points, ends exclusive. Equal rows (doc_id and text) are
    gone over once and share a ``row`` key.
    """
    text = F.col("text")
    some = docs.select("doc_id", "text").filter(strong_flag(text))
    once = some.select(_row_key(F.col("doc_id"), text).alias("row"), "text").dropDuplicates(["row"])
    low = F.lower(text)
    kinds = [F.when(_holds(low, w), _matches(text, i, p)) for i, (_, p, w) in enumerate(STRONG + WEAK)]
    kinds.append(_matches(text, BREAK, BLANK))
    none = F.array().cast("array<struct<kind:int,gap:int,match:string>>")
    every = F.flatten(F.array(*[F.coalesce(k, none) for k in kinds]))
    found = once.select("row", F.posexplode(every).alias("i", "p")).select("row", "i", "p.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    spans = found.select("row", "kind", "match", end.alias("end")).withColumn("start", F.col("end") - F.length("match"))
    value = F.length(F.regexp_replace("match", "^" + ASSIGN, ""))
    whole = F.length("match")
    told = F.when((F.col("kind") == 0) & (value < LEAST_VALUE), SHORT)
    told = told.when((F.col("kind") == KINDS.index("endpoint")) & F.rlike("match", F.lit("://" + USERINFO)), CONNECTION).otherwise(F.col("kind"))
    # a mixed token has a digit, an upper and a lower case letter
    mixed = F.rlike("match", F.lit("[0-9]")) & F.rlike("match", F.lit("[A-Z]")) & F.rlike("match", F.lit("[a-z]"))
    ok = F.when(F.col("kind") == 1, whole >= LEAST_ACCESS).when(F.col("kind") == KINDS.index("mixed"), mixed).otherwise(True)
    return spans.filter(ok).withColumn("kind", told)


def credentials(spans: DataFrame) -> DataFrame:
    """One row per credential: (row, kind, start, end) of its secret, ``with``: its weak parts beside the secret.

    Weak parts that overlap a strong span or a connection string are dropped as
    already reported. An identifier and a secret at most ``SCOPE`` apart and in
    one block of lines are one credential; so far an endpoint belongs to the
    secret too. An access identifier inside the secret's own span is no
    identifier of it. A connection string is a credential by itself. Links
    between two strong spans are credentials without weak parts.
    """
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    strong = F.col("kind") < len(STRONG)
    covers = strong | (F.col("kind") == CONNECTION)
    before = F.max(F.when(covers, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(covers, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    covered = ~covers & ((F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end")))
    para = F.sum((F.col("kind") == BREAK).cast("int")).over(by_start)
    parts = spans.withColumns({"covered": covered, "para": para}).filter(~F.col("covered") & (F.col("kind") != BREAK))
    block = F.floor(F.col("start") / SCOPE)
    # a secret is met in the blocks its scope reaches; others lie in the blocks they touch
    low, high = F.floor((F.col("start") - SCOPE) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE)
    secret = F.col("kind").isin(*SECRETS)
    secrets = parts.filter(secret).select("row", "para", F.col("kind").alias("tk"), F.col("start").alias("ts"), F.col("end").alias("te"), F.explode(F.sequence(low, high)).alias("block"))
    others = parts.filter(F.col("kind").isin(*IDENTIFIERS, KINDS.index("endpoint")))
    others = others.select("row", "para", "kind", "start", "end", F.explode(F.sequence(block, F.floor(F.col("end") / SCOPE))).alias("block"))
    near = secrets.join(others, ["row", "para", "block"]).filter((F.col("start") <= F.col("te") + SCOPE) & (F.col("end") + SCOPE >= F.col("ts")))
    near = near.filter((F.col("kind") != 1) | (F.col("end") <= F.col("ts")) | (F.col("start") >= F.col("te")))
    weak = F.struct("kind", "start", "end")
    kept = near.groupBy("row", "tk", "ts", "te").agg(
        F.max(F.col("kind").isin(*IDENTIFIERS)).alias("ok"), F.collect_set(F.when(F.col("kind") >= len(STRONG), weak)).alias("with")
    ).filter("ok")
    kept = kept.select("row", F.col("tk").alias("kind"), F.col("ts").alias("start"), F.col("te").alias("end"), "with")
    whole = parts.filter(F.col("kind") == CONNECTION).select("row", "kind", "start", "end", F.array().cast(kept.schema["with"].dataType).alias("with"))
    return kept.union(whole)


def linked(found: DataFrame) -> DataFrame:
    """The weak parts to report of the credentials found: (row, kind, start, end)."""
    own = F.struct("kind", "start", "end")
    each = found.select("row", F.explode(F.concat(F.array(own), "with")).alias("p"))
    return each.select("row", "p.*").filter(F.col("kind") >= len(STRONG)).distinct()


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak, n_credentials.

    ``n_weak`` counts the linked weak parts among the spans, ``n_credentials`` the linked secrets.
    Null and empty texts have no spans; a null doc_id stays null; equal rows give
    equal rows; an empty table gives no rows. Other columns are not read.
    """
    from learner_scoring.llm.common import cut

    spans = cut(part_spans(docs))
    strong = spans.filter(F.col("kind") < len(STRONG)).select("row", "kind", "start", "end")
    creds = cut(credentials(spans))
    counted = creds.groupBy("row").agg(F.count("*").alias("n_credentials"))
    listed = strong.unionByName(linked(creds)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all")
    )
    found = listed.select("row", "all", F.filter("all", lambda s: s["kind"] < len(STRONG)).alias("base"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    cols = [count(i).alias(f"n_{k}") for i, (k, _, _) in enumerate(STRONG)]
    told = found.select("row", *cols, _joined(F.col("base")).alias("base"), _joined(F.col("all")).alias("spans"), (F.size("all") - F.size("base")).cast("long").alias("n_weak"))
    rows = docs.select("doc_id", _row_key(F.col("doc_id"), F.col("text")).alias("row"))
    out = rows.join(told.join(counted, "row", "left"), "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    text = lambda c: F.coalesce(c, F.lit(""))
    return out.select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), zero("n_weak"), zero("n_credentials")
    )
