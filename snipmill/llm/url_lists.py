"""URL filters whose lists change over time, in DataFrame functions alone.

A list is a log of dated entries: on some day a domain or a URL prefix was added,
on another removed. Entries become validity intervals: an addition holds from its
time up to the next entry for the same value of that list, exclusively. Each capture
is then judged as of its fetch time: it is blocked if an entry that covers its URL
was active when it was fetched, whatever the list says today.

A domain covers its host and all subdomains; a prefix, host and path without scheme,
covers URLs at and below it. Captures are compared by URL and time once, however many
rows have both. Both sides of the as-of join meet by value and month, so neither a
host with many captures nor a value with many entries meets in one place; months
bound the copies of long intervals, and joins split what is still hot. Lists are
never broadcast by hint.

Results, defined for every input: a capture without url, host or time is covered by
nothing and passes. Entries without list, value, time or known kind and action are
ignored. Of entries of a value at the same time a removal wins. Repeated entries count
once, repeated captures each get a row. Further columns are ignored for entries and
kept for captures, whatever their names; one that is named like a result is kept as
``own_`` and its name, with as many ``own_`` as it takes to be told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOMAIN, PREFIX = "domain", "prefix"
RESULTS = ["blocked", "matches", "match"]
_KEY = ["list", "kind", "value"]


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a dot at its end; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return F.regexp_replace(F.lower(found), r"\.$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def covering_domains(host: Column) -> Column:
    """The host and the domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def covering_prefixes(host: Column, path: Column) -> Column:
    """The host and host with each begin of the path."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda i: F.array_join(F.concat(F.array(host), F.slice(parts, F.lit(1), i)), "/"),
    )


def normal_value(kind: Column, value: Column) -> Column:
    """Values of entries as the functions above spell them."""
    bare = F.regexp_replace(value, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?#:]*)", 1))
    rest = F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(rest, "/"), lambda x: x != "")
    prefix = F.array_join(F.concat(F.array(host), parts), "/")
    return F.when(kind == DOMAIN, F.regexp_replace(F.lower(value), r"^\.+|\.+$", "")).otherwise(prefix)


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of a log with ``list``, ``kind``, ``value``, ``at`` and ``action``
    (add or remove): ``valid_from`` inclusive, ``valid_to`` exclusive, null if open.

    A value's entries are ordered month by month; only the first of each month are
    ordered over all months.
    """
    kind, action = F.lower(F.col("kind")), F.lower(F.col("action"))
    log = (
        entries.select(
            "list", kind.alias("kind"), normal_value(kind, F.col("value")).alias("value"),
            F.col("at").cast("timestamp").alias("at"), action.alias("action"),
        )
        .where(F.col("kind").isin(DOMAIN, PREFIX) & F.col("action").isin("add", "remove"))
        .where("list IS NOT NULL AND at IS NOT NULL AND value <> ''")
        .groupBy(*_KEY, "at")
        .agg(F.max("action").alias("action"))  # remove is behind add
        .withColumn("month", F.trunc("at", "month"))
    )
    months = log.groupBy(*_KEY, "month").agg(F.min("at").alias("first"))
    months = months.withColumn(
        "then", F.lead("first").over(Window.partitionBy(*_KEY).orderBy("month"))
    ).drop("first")
    inside = Window.partitionBy(*_KEY, "month").orderBy("at")
    return (
        log.withColumn("next", F.lead("at").over(inside))
        .join(months, [*_KEY, "month"])
        .where("action = 'add'")
        .select(*_KEY, F.col("at").alias("valid_from"), F.coalesce("next", "then").alias("valid_to"))
    )


def kept_names(columns: list[str]) -> list[str]:
    """Names under which the columns of captures stand in the result."""
    taken = {c.lower() for c in columns} | set(RESULTS)
    out = []
    for name in columns:
        if name.lower() in RESULTS:
            while name.lower() in taken:
                name = f"own_{name}"
            taken.add(name.lower())
        out.append(name)
    return out


def judged(
    captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at"
) -> DataFrame:
    """Captures with ``blocked``, the number of active entries that cover them,
    ``matches``, and the first of these by list, kind and value, ``match``."""
    # Columns of captures go by number until the end, so no name can clash.
    lower = [c.lower() for c in captures.columns]
    numbered = captures.toDF(*(f"c{i}" for i in range(len(lower))))
    rows = numbered.withColumns(
        {
            "_url": F.col(f"c{lower.index(url_col.lower())}"),
            "_at": F.col(f"c{lower.index(time_col.lower())}").cast("timestamp"),
        }
    )
    asked = (
        rows.select("_url", "_at")
        .where("_url IS NOT NULL AND _at IS NOT NULL")
        .distinct()
        .withColumn("_host", host_of(F.col("_url")))
        .where("_host <> ''")
    )
    host, path = F.col("_host"), path_of(F.col("_url"))
    keyed = lambda kind, values: F.transform(
        values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    )
    keys = F.concat(keyed(DOMAIN, covering_domains(host)), keyed(PREFIX, covering_prefixes(host, path)))
    covered = asked.select("_url", "_at", F.trunc("_at", "month").alias("month"), F.explode(keys).alias("k"))
    covered = covered.select("_url", "_at", "month", "k.kind", "k.value")

    span = rows.agg(F.min("_at").alias("a"), F.max("_at").alias("b")).head()  # one row
    low, high = F.lit(span.a).cast("timestamp"), F.lit(span.b).cast("timestamp")
    begin = F.greatest("valid_from", low)
    end = F.least(F.coalesce("valid_to", high), high)
    months = F.sequence(F.trunc(begin, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
    active = (
        intervals(entries)
        .where((F.col("valid_from") <= high) & (F.coalesce("valid_to", high) >= low))
        .withColumn("month", F.explode(months))
    )
    then = (F.col("_at") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))
    )
    hits = (
        covered.join(active, ["kind", "value", "month"])
        .where(then)
        .groupBy("_url", "_at")
        .agg(F.count("*").alias("matches"), F.min(F.struct(*_KEY)).alias("match"))
    )
    kept = zip(numbered.columns, kept_names(captures.columns))
    return rows.join(hits, ["_url", "_at"], "left").select(
        *(F.col(c).alias(name) for c, name in kept),
        F.col("matches").isNotNull().alias("blocked"),
        F.coalesce("matches", F.lit(0)).alias("matches"),
        "match",
    )
