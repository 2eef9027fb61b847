"""Secret scans, DataFrame functions only: pattern spans and corpus-wide ownership of candidates.

Base spans (assign, access, hex) come from fixed patterns.  Further kinds are
only candidates; their values are hashed and counted over the whole corpus by
distinct repositories and owners.  A value that few owners hold looks like a
live credential and its span is added; one that many hold is a copied example
and is not.  Base spans always stay; how many of a document's spans look live
is reported.  A private key reaches to its END line (without one, as far as its
body goes on) and is known by its base64 body, however it is indented, escaped
or headed; a BEGIN line without a body tells nothing of its key and always
looks live.

Counting goes by (value, owner, repository) first, so a value copied into a
third of all rows is one row per task before it moves; the join back is on
narrow rows and split by AQE's skew join.

Defined results: null text is empty text; a null owner or repository counts as
one of its own; every input row gives one output row, whatever its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialize

#: Fixed patterns of the base kinds: the value is the numbered group, with at least so many characters.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A private key: all up to the END line, if no other line of five hyphens comes first; else header
#: lines and base64 lines, indented, quoted or with escaped line ends.
_GAP = r"""(?:\\{1,4}[nrt]|[\s"'+,>#|*]){0,80}+"""
PEM = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
       r"(?:(?:[^-]++|-(?!----))*+-{5,9}END [A-Z ]{0,40}PRIVATE KEY-----"
       rf"|(?:{_GAP}[A-Za-z][A-Za-z0-9-]{{0,40}}:[^\n\r\\]*+)*+(?:{_GAP}[A-Za-z0-9+/=]{{16,}}+)*+(?:{_GAP}[A-Za-z0-9+/]++=++)?+"
       r"[A-Za-z0-9+/=\n\r]*)")
#: What is no part of a key's body: its first and last line, escapes, header lines, all but base64.
PEM_FRAME = r"-{5,9}(?:BEGIN|END) [A-Z ]{0,40}PRIVATE KEY-----|\\+[nrt]|[A-Za-z][A-Za-z0-9-]{0,40}:[^\n\r\\]*+|[^A-Za-z0-9+/=]"
KINDS = {
    "assign": (ASSIGN, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "pem": (PEM, 0, 0),
    "service": (r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,}"
                r"|eyJ[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,})", 0, 1),
    "login": (r"://[^\s/:@]++:([^\s/@]{6,}+)@", 1, 6),
    "opaque": (r"[A-Za-z0-9_-]{32,}", 0, 32),
}
BASE = ("assign", "access", "hex")
#: Cheap tests that hold wherever the kind has a match that counts.  A run of 24 hexadecimal
#: digits is found by the same test that finds its maximal run.
HINTS = {
    "assign": r"""(?i:passw|secret|token|api_?key)[A-Za-z]*["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "pem": r"-----BEGIN ",
    "service": r"gh[pousr]_|xox[abpr]-|sk_live_|eyJ",
    "login": r"://[^\s/:@]++:",
    "opaque": r"[A-Za-z0-9_-]{32}",
}
MAX_OWNERS = 2
MAX_REPOSITORIES = 4
MIN_DISTINCT = 16

_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string>>"


CHUNK = 64  # elements of an array that one step of a scan looks at
_OPAQUE = [*"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-"]


def _let(value: Column, body) -> Column:
    """``body`` of a column that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scanned(rows: Column, zero: Column, measure, join, element) -> Column:
    """``element(x, before)`` of every x in an array, ``before`` being ``join`` over the measures of all
    earlier ones: by chunks, whose totals are joined first, so that work grows with the array and not with its square."""
    def total(part: Column, start: Column) -> Column:
        return F.aggregate(part, start, lambda state, x: join(state, measure(x)))

    def chunk(r: Column, c: Column) -> Column:
        return F.slice(r, c * CHUNK + 1, F.lit(CHUNK))

    def own(part: Column, start: Column) -> Column:
        places = F.transform(part, lambda x, i: F.struct(x.alias("x"), total(F.slice(part, F.lit(1), i), start).alias("before")))
        return F.transform(places, lambda p: element(p["x"], p["before"]))

    def whole(r: Column) -> Column:
        every = F.sequence(F.lit(0), F.floor((F.size(r) - 1) / CHUNK).cast("int"))
        totals = F.transform(every, lambda c: total(chunk(r, c), zero))
        return _let(totals, lambda t: F.flatten(F.transform(every, lambda c: _let(
            F.struct(chunk(r, c).alias("part"), F.aggregate(F.slice(t, F.lit(1), c), zero, join).alias("start")),
            lambda k: own(k["part"], k["start"])))))

    return _let(rows, lambda r: F.when(F.size(r) > 0, whole(r)))


def _shaped(kind: str, value: Column) -> Column:
    if kind != "opaque":
        return F.lit(True)
    distinct = F.aggregate(F.array(*map(F.lit, _OPAQUE)), F.lit(0), lambda n, c: n + F.contains(value, c).cast("int"))
    return (value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9].*[0-9]")) & (distinct >= MIN_DISTINCT)


def _spans(text: Column, no: int, kind: str) -> Column:
    """Leftmost non-overlapping matches with their code point places: what lies between
    matches is split off, and the lengths before a match add up to its start."""
    pattern, group, least = KINDS[kind]
    if kind == "hex" or kind == "access":  # a maximal run that is long enough is found as such
        pattern = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    if kind == "pem":
        values = F.transform(found, lambda m: F.regexp_replace(m, PEM_FRAME, ""))
    lengths = F.zip_with(F.split(text, pattern, -1), found, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("long")))
    rows = F.zip_with(lengths, values, lambda x, v: F.struct(x["gap"].alias("gap"), x["long"].alias("long"), v.alias("value")))
    none = F.lit(None).cast(_SPAN)

    def span(x: Column, before: Column) -> Column:
        begin = before + x["gap"]
        return F.struct(begin.alias("start"), F.lit(no).alias("kind_no"), (begin + x["long"]).alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))

    spans = F.filter(_scanned(rows, F.lit(0), lambda x: x["gap"] + x["long"], lambda m, n: m + n, span),
                     lambda x: x["value"].isNotNull() & (F.length(x["value"]) >= least) & _shaped(kind, x["value"]))
    return F.coalesce(F.when(text.rlike(HINTS[kind]), spans.cast(_SPAN)).otherwise(none), F.array().cast(_SPAN))


def candidate_spans(text: Column) -> Column:
    """All spans of all kinds, by start, then kind as listed."""
    return F.array_sort(F.concat(*[_spans(text, no, kind) for no, kind in enumerate(KINDS)]))


def ownership(candidates: DataFrame) -> DataFrame:
    """Rows (value_hash, owner, repository) -> distinct owners and repositories of each value."""
    held = candidates.groupBy("value_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = held.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"),
                                              F.sum("repositories").alias("repositories"), F.sum("n").alias("found"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _judged(found: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """``found`` (row, owner, repository, all_spans, ...) with base and kept spans and the number that looks live."""
    per = (found.where(F.size("all_spans") > 0).select("row", "owner", "repository", F.explode("all_spans").alias("s"))
           .withColumn("value_hash", F.sha2("s.value", 256)))
    known = ownership(per.select("value_hash", F.coalesce("owner", F.lit("")).alias("owner"),
                                 F.coalesce("repository", F.lit("")).alias("repository")))
    live = known.where((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).select(
        "value_hash", F.lit(True).alias("live"))
    bare = (F.col("s.kind") == "pem") & (F.col("s.value") == "")
    verdict = (per.select("row", "s", "value_hash").join(live, "value_hash", "left")
               .groupBy("row").agg(F.collect_list(F.struct(
                   "s.start", "s.kind_no", "s.end", "s.kind", F.coalesce(F.col("live"), bare).alias("live"))).alias("judged")))
    spans = F.array_sort(F.coalesce("judged", F.array().cast(
        "array<struct<start:int,kind_no:int,end:int,kind:string,live:boolean>>")))
    return (found.drop("all_spans").join(verdict, "row", "left").withColumn("judged", spans)
            .withColumn("base", F.filter("judged", lambda s: s["kind_no"] < len(BASE)))
            .withColumn("kept_spans", F.filter("judged", lambda s: (s["kind_no"] < len(BASE)) | s["live"]))
            .withColumn("n_live", F.size(F.filter("judged", lambda s: s["live"])).cast("long")).drop("judged"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
         repository: Column | None = None, max_owners: int = MAX_OWNERS,
         max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined),
    n_live and n_copied, the candidates that few and that many owners hold."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    narrow = df.select(F.col(f"`{id_col}`").alias("id"), _or_null(owner, "owner"), _or_null(repository, "repository"),
                       candidate_spans(text).alias("all_spans"), F.monotonically_increasing_id().alias("row"))
    found = materialize(narrow, "secret-spans")  # fixes the row numbers; spans only, no text
    n_all = F.size("all_spans").alias("n_all")
    judged = _judged(found, max_owners, max_repositories).join(found.select("row", n_all), "row")
    counts = [_of_kind(k).cast("long").alias(f"n_{k}") for k in BASE]
    return judged.select(F.col("id").alias(id_col), *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                         _written(F.col("kept_spans")).alias("spans"), "n_live",
                         (F.col("n_all") - F.col("n_live")).alias("n_copied"))


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def _or_null(column: Column | None, name: str) -> Column:
    return (F.lit(None) if column is None else column).cast("string").alias(name)


def _marked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with a mark for every maximal run of overlapping ``spans`` (by start; at least one)."""
    # of every run: where the text before it begins, and where the run does
    gaps = F.filter(_scanned(spans, F.lit(0), lambda s: s["end"], lambda m, n: F.greatest(m, n),
                             lambda s, before: F.struct(before.alias("begin"), s["start"].alias("end"))), lambda g: g["end"] >= g["begin"])

    def part(g: Column, c: Column) -> Column:
        """Some gaps, cut from a stretch of the text that is cut out once."""
        own = F.slice(g, c * CHUNK + 1, F.lit(CHUNK))
        first = F.element_at(own, 1)["begin"]
        return _let(F.struct(own.alias("own"), first.alias("first"), F.substring(text, first + 1, F.element_at(own, -1)["end"] - first).alias("stretch")),
                    lambda p: F.array_join(F.transform(p["own"], lambda x: F.concat(
                        F.substring(p["stretch"], x["begin"] - p["first"] + 1, x["end"] - x["begin"]), F.lit(mark))), ""))

    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    before = _let(gaps, lambda g: F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(g) - 1) / CHUNK).cast("int")), lambda c: part(g, c)), ""))
    return F.concat(before, F.substring(text, last + 1, F.length(text)))


def redact(df: DataFrame, text_col: str = "text", owner: Column | None = None, repository: Column | None = None,
           max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, mark: str = "[secret]") -> DataFrame:
    """``df`` with every kept span of its texts replaced by ``mark`` (overlapping spans: one mark).

    Rows that no hint applies to pass as they are; only the others are written and judged."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    hinted = F.lit(False)
    for hint in HINTS.values():
        hinted = hinted | text.rlike(hint)
    columns = [F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(df.columns)]
    back = [F.col(f"c_{i}").alias(c) for i, c in enumerate(df.columns)]
    at = f"c_{df.columns.index(text_col)}"
    narrow = df.where(hinted).select(
        *columns, _or_null(owner, "owner"), _or_null(repository, "repository"),
        candidate_spans(text).alias("all_spans"), F.monotonically_increasing_id().alias("row"))
    found = materialize(narrow, "secret-texts")
    judged = _judged(found, max_owners, max_repositories)
    marked = judged.withColumn(at, F.when(F.size("kept_spans") > 0, _marked(F.col(at), F.col("kept_spans"), mark)).otherwise(F.col(at)))
    return df.where(~hinted).unionByName(marked.select(*back))
