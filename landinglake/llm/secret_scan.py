"""Credentials in documents, judged by who owns copies of them across the whole corpus.

Candidates are found by fixed patterns, each leftmost and without overlap. The hash of every
candidate value is then counted over the corpus: by distinct owners, distinct repositories and
distinct contexts, the ``CONTEXT`` characters on either side of it. A value is widely copied if each
of the three is at least ``example_owners``; copies of one passage have one context, so they are no
sign that a value is an example. The verdict of a span is ``live`` if its value looks random and is
not widely copied, ``shared`` if it looks random and is, ``example`` if it is widely copied and does
not look random, else ``other``. Three kinds are always spans (``BASE``); vendor formats are added
unless they are examples. Only examples are left by ``redact``: what looks live never is.

DataFrame functions only. Texts that can have no candidate are filtered first by plain substrings
and the hex pattern, so that positions, which are running sums over the gaps between matches, are
made for the few others. Candidates are few; they are stored, so that texts are scanned once for the
counts and the spans. A value that a third of all documents hold is counted in steps, each combined
before its shuffle, and its spans meet the counts in a join that AQE can split.

Edge cases: a null text reads as empty and has no spans; a null owner or repository counts as one
of its own; repeated rows have the same spans and are one row in the counts; kinds that begin at one
place are in the order listed; a very long text is scanned whole, within its row; an empty table gives an empty result; other columns
are ignored. Positions are code points, the end exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landinglake.llm.tables import free_name, stored
from landinglake.operators.joins import skew_join

# The patterns of the base kinds; group 2 of the first is the value.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
VENDOR = (r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
          r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")
# Kind, pattern, group of the value, least length of the value; in the order of ties.
BASE = (("assign", ASSIGN, 2, LEAST_VALUE), ("access", ACCESS, 0, 0), ("hex", HEX, 0, 0))
KINDS = (*BASE, ("vendor", VENDOR, 0, 0))
EXAMPLE_OWNERS = 3
# Characters before and after a value that tell copies of one passage from uses of the value.
CONTEXT = 24
LEAST_LIVE = 16
MADE_UP = r"(?i)example|sample|dummy|changeme|placeholder|xxxx|00000000|12345678"

# What a text with a candidate contains, in lower case or as it is, unless it has a long hex run.
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_PREFIXES = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "AIza", "eyJ")


def may_have_candidates(text: Column) -> Column:
    """True for every text with a candidate and for few others, without trying all patterns."""
    lower = F.lower(text)
    simple = [*(lower.contains(k) for k in _KEYWORDS), *(text.contains(p) for p in _PREFIXES)]
    return F.coalesce(reduce(Column.__or__, simple) | text.rlike(HEX), F.lit(False))


def looks_live(value: Column) -> Column:
    """Long, with letters and digits, and without the usual words of made-up values."""
    return ((F.length(value) >= LEAST_LIVE) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & ~value.rlike(MADE_UP))


def _key(text: Column, *columns: str) -> Column:
    """Names a row; equal rows share it and have the same spans."""
    return F.xxhash64(*columns, text)


def candidates(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """(key, owner, repository, kind_no, start, end, value, live, context): every candidate of
    ``docs`` once per distinct row."""
    text = F.col("text")
    rows = (docs.filter(may_have_candidates(text))
            .select(_key(text, "doc_id", owner, repository).alias("key"),
                    F.col(owner).cast("string").alias("owner"),
                    F.col(repository).cast("string").alias("repository"), "text"))
    # Per kind, columns of their own, so that each pattern is run once for each of them.
    for number, (_, pattern, group, _) in enumerate(KINDS):
        rows = rows.withColumns({
            f"whole{number}": F.regexp_extract_all("text", F.lit(pattern), F.lit(0)),
            f"gap{number}": F.split("text", pattern, -1)})
    found = []
    for number, (_, pattern, group, _) in enumerate(KINDS):
        whole, gaps = F.col(f"whole{number}"), F.col(f"gap{number}")
        value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else whole
        found.append(F.arrays_zip(
            whole.alias("whole"), value.alias("value"), gaps.alias("gap"),
            F.slice(gaps, 2, F.size(whole)).alias("after"),
            F.array_repeat(F.lit(number), F.size(whole)).alias("kind_no")))
    lists = rows.select("key", "owner", "repository", F.flatten(F.array(*found)).alias("found"))
    each = lists.select("key", "owner", "repository", F.posexplode("found").alias("at", "m"))
    # The gap after the last match has no match beside it.
    each = each.select(
        "key", "owner", "repository", "at", F.col("m.kind_no").alias("kind_no"),
        F.length("m.whole").alias("length"), F.length("m.gap").alias("gap"),
        F.right("m.gap", F.lit(CONTEXT)).alias("before"),
        F.left("m.after", F.lit(CONTEXT)).alias("after"), F.col("m.value").alias("secret")) \
        .filter("length is not null")
    once = each.groupBy("key", "kind_no", "at").agg(*(F.first(c).alias(c) for c in (
        "owner", "repository", "length", "gap", "secret", "before", "after")))
    before = (Window.partitionBy("key", "kind_no").orderBy("at")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.sum(F.col("gap") + F.col("length")).over(before).cast("bigint")
    least = F.lit(0)
    for number, (_, _, _, length) in enumerate(KINDS):
        least = F.when(F.col("kind_no") == number, F.lit(length)).otherwise(least)
    return (once.withColumn("end", end).filter(F.length("secret") >= least)
            .select("key", "owner", "repository", "kind_no",
                    (F.col("end") - F.col("length")).alias("start"), "end",
                    F.sha2("secret", 256).alias("value"), looks_live(F.col("secret")).alias("live"),
                    F.xxhash64("before", "after").alias("context")))


def ownership(found: DataFrame) -> DataFrame:
    """(value, owners, repositories, contexts): how many distinct ones each candidate value has.

    A repository belongs to an owner, so (owner, repository) tells repositories apart. Rows are
    combined per value and distinct one before they are counted, so no group holds all rows of a
    value.
    """
    def several(name: str, *columns: str) -> DataFrame:
        one = found.groupBy("value", *columns).agg(F.count(F.lit(1)).alias("spans"))
        return one.groupBy("value").agg(F.count(F.lit(1)).alias(name))

    return several("owners", "owner").join(
        several("repositories", "owner", "repository"), "value").join(
        several("contexts", "context"), "value")


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
                 example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(key, spans) of every distinct row with spans, in order of start and kind; a span has
    start, kind_no, end, verdict (example, live, shared or other), owners, repositories and
    contexts."""
    found = stored(candidates(docs, owner, repository), "candidates")
    copied = F.least("owners", "repositories", "contexts") >= example_owners
    verdict = (F.when(F.col("live"), F.when(copied, "shared").otherwise("live"))
               .when(copied, "example").otherwise("other"))
    judged = (skew_join(found, ownership(found), "value").withColumn("verdict", verdict)
              .filter((F.col("kind_no") < len(BASE)) | (F.col("verdict") != "example")))
    span = F.struct("start", "kind_no", "end", "verdict", "owners", "repositories", "contexts")
    return judged.groupBy("key").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def _spans_of(column: Column | str, wanted=None) -> Column:
    """The spans as kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(kind[0]) for kind in KINDS))
    spans = F.filter(column, wanted) if wanted else column
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def document_spans(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
                   example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans, live, shared, examples, copies) for every
    row of ``docs`` (doc_id, text and the owner and repository columns): counts and lists of spans,
    and per span owners/repositories/contexts of its value."""
    no_spans = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,verdict:string,"
                              "owners:bigint,repositories:bigint,contexts:bigint>>")
    rows = docs.select("doc_id", _key(F.col("text"), "doc_id", owner, repository).alias("key"))
    spans = F.coalesce("spans", no_spans).alias("all_spans")
    joined = rows.join(scan_secrets(docs, owner, repository, example_owners), "key", "left")

    def number_of(kind_no):
        return F.size(F.filter("all_spans", lambda s: s["kind_no"] == kind_no)).cast("bigint")

    counts = [number_of(n).alias(f"n_{kind[0]}") for n, kind in enumerate(BASE)]
    return joined.select("doc_id", spans).select(
        "doc_id", *counts,
        _spans_of("all_spans", lambda s: s["kind_no"] < len(BASE)).alias("base"),
        _spans_of("all_spans").alias("spans"),
        _spans_of("all_spans", lambda s: s["verdict"] == "live").alias("live"),
        _spans_of("all_spans", lambda s: s["verdict"] == "shared").alias("shared"),
        _spans_of("all_spans", lambda s: s["verdict"] == "example").alias("examples"),
        F.array_join(F.transform("all_spans", lambda s: F.concat_ws(
            "/", *(s[c].cast("string") for c in ("owners", "repositories", "contexts")))), ",")
        .alias("copies"))


def redact(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
           mark: str = "[secret]", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``docs`` with every span that is not an example replaced by ``mark``; all
    columns stay, and rows without such spans are not shuffled."""
    key, cut = free_name(docs, "row_key"), free_name(docs, "cut")
    spans = scan_secrets(docs, owner, repository, example_owners).select(
        F.col("key").alias(key),
        F.filter("spans", lambda s: s["verdict"] != "example").alias(cut))
    may = may_have_candidates(F.col("text"))
    # Spans may overlap: what is not yet copied begins where the last one ended.
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        piece = F.substring("text", (state["at"] + 1).cast("int"),
                            F.greatest(span["start"] - state["at"], F.lit(0)).cast("int"))
        done = F.when(fresh, F.concat(state["done"], piece, F.lit(mark))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.greatest(state["at"], span["end"]).alias("at"))

    redacted = F.aggregate(cut, start, step, lambda s: F.concat(
        s["done"], F.substring("text", (s["at"] + 1).cast("int"), F.length("text"))))
    touched = docs.filter(may).withColumn(key, _key(F.col("text"), "doc_id", owner, repository))
    text = F.when(F.size(F.coalesce(cut, F.array())) > 0, redacted).otherwise(F.col("text"))
    touched = touched.join(spans, key, "left").withColumn("text", text)
    return docs.filter(~may).unionByName(touched.select(*docs.columns))
