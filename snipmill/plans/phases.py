"""Stage 3, data half: phases that draw from a pool one after the other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from snipmill.functions.hashing import draw
from snipmill.operators.ranking import hash_bucket, reaching_buckets
from snipmill.operators.sampling import (
    REPLAY_LANGUAGE,
    replay_quota,
    row_key,
    shuffled,
)
from snipmill.operators.splits import split_train_validation, step_plan
from snipmill.schemas import TEXT, struct
from snipmill.session import materialise


@dataclass(frozen=True)
class Phase:
    """What one phase draws and how long it trains on it."""

    name: str
    language: str | None
    num_samples: int
    epochs: int
    replay_ratio: float = 0.0
    warmup_ratio: float = 0.1
    replay_rows: int = 0

    def most_replay_rows(self, replay_language: str) -> int:
        """Replay rows if there are as many main rows as asked for."""
        return replay_quota(
            self.num_samples, self.language, self.replay_ratio, self.replay_rows, replay_language
        )

    def replay_quota(self, main_rows: int, replay_language: str) -> int:
        """Replay rows that go with the main rows there are."""
        return replay_quota(
            main_rows, self.language, self.replay_ratio, self.replay_rows, replay_language
        )


# The phases of one cycle.
PHASES = (
    Phase("Python_Focus", "python", 300, 3, 0.0),
    Phase("CPP_Introduction", "cpp", 200, 3, 0.15),
    Phase("Java_Introduction", "java", 200, 3, 0.10),
    Phase("Final_Mixed_Tune", None, 250, 2, 0.20),
)

SELECTION = struct(
    phase=TEXT, role=TEXT, snippet_id=TEXT, language=TEXT, row_key=TEXT, position=LongType()
)


@dataclass(frozen=True)
class _Request:
    """One draw of a phase: at most ``rows`` of a language, when at most
    ``used_before`` ids are taken already."""

    phase: Phase
    role: str
    language: str | None
    rows: int
    used_before: int

    @property
    def salt(self) -> str:
        return self.phase.name if self.role == "main" else f"{self.phase.name} replay"


def _requests(phases: Sequence[Phase], replay_language: str) -> list[_Request]:
    requests, used = [], 0
    for phase in phases:
        for role, language, rows in (
            ("main", phase.language, phase.num_samples),
            ("replay", replay_language, phase.most_replay_rows(replay_language)),
        ):
            if rows:
                requests.append(_Request(phase, role, language, rows, used))
                used += rows
    return requests


def _dealt(values: Sequence[object], request: Column) -> Column:
    """The value that belongs to a request."""
    return F.get(F.array(*(F.lit(x) for x in values)), request)


def _candidates(
    pool: DataFrame, requests: Sequence[_Request], most: int
) -> tuple[DataFrame, int, int]:
    """Rows that can be drawn by a request: its smallest draws, as many as it
    asks for and as could be taken before, if no id has more than ``most`` rows. All
    others are out of reach, so the phases need not look at the pool again. Also the most
    languages of an id found, and the most rows of an id in one language.

    Two scans of ids and languages serve all requests: one counts the draws per
    bucket, the other keeps the buckets within reach. Rows that share an id are
    one row with their number, so an id that many rows have is no hot group.
    """
    draws = F.array(
        *(
            F.when(
                F.col("language") == r.language if r.language else F.lit(True),
                F.struct(F.lit(i).alias("request"), draw(r.salt, row_key(pool)).alias("draw")),
            )
            for i, r in enumerate(requests)
        )
    )
    drawn = pool.select(
        "snippet_id",
        "language",
        row_key(pool).alias("row_key"),
        F.explode(F.array_compact(draws)).alias("d"),
    ).select("snippet_id", "language", "row_key", "d.request", "d.draw")
    needs = _dealt([r.rows + r.used_before * most for r in requests], F.col("request"))
    # One row per request comes to the driver.
    reach = {
        row["request"]: row["last_bucket"]
        for row in reaching_buckets(drawn, ["request"], "draw", needs).collect()
    }
    last = _dealt([reach.get(i) for i in range(len(requests))], F.col("request"))
    entry = ["request", "draw", "language"]
    keys = (
        drawn.where(hash_bucket(F.col("draw")) <= last)
        .groupBy("snippet_id", "row_key", *entry)
        .agg(F.count("*").alias("rows"))
        .groupBy("snippet_id", "row_key")
        .agg(F.sort_array(F.collect_list(F.struct(*entry, "rows"))).alias("entries"))
    )
    seen = Observation()
    languages = F.size(F.array_distinct(F.col("entries.language")))
    rows = F.array_max(F.col("entries.rows"))
    keys = keys.observe(seen, F.max(languages).alias("languages"), F.max(rows).alias("rows"))
    written = materialise(keys, "candidates")
    return written, seen.get["languages"] or 0, seen.get["rows"] or 0


# Draws are hex digits: these stand before and behind all of them.
_NONE, _ALL = "", "g"


@dataclass(frozen=True)
class _Edge:
    """How far a request reaches: its largest draw, and how many rows it takes of that."""

    draw: str = _NONE
    rows: int = 0
    free: int = 0


def _free(keys: DataFrame, edges: Sequence[_Edge]) -> DataFrame:
    """Candidates of each request whose id no earlier request reaches. Rows without
    id are never used up."""
    reached = F.filter("entries", lambda e: e["draw"] <= _dealt([x.draw for x in edges], e["request"]))
    first = keys.withColumn("first", F.get(reached, F.lit(0))["request"])
    left = F.filter(
        "entries",
        lambda e: F.col("snippet_id").isNull() | F.col("first").isNull() | (e["request"] <= F.col("first")),
    )
    return first.select("snippet_id", "row_key", F.explode(left).alias("e")).select(
        "snippet_id", "row_key", "e.*"
    )


def _edges(free: DataFrame, wanted: Sequence[int]) -> list[_Edge]:
    """How far each request reaches to get the rows it wants out of its free ones.
    One row per request comes to the driver."""
    want = _dealt(wanted, F.col("request"))
    slices = free.groupBy("request", hash_bucket(F.col("draw")).alias("slice")).agg(
        F.sum("rows").alias("n")
    )
    group = Window.partitionBy("request")
    before = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "request",
        "slice",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"),
        F.sum("n").over(group).alias("free"),
    )
    last = (
        offsets.where(F.col("below") < want)
        .groupBy("request")
        .agg(F.max(F.struct("slice", "below", "free")).alias("last"))
        .select("request", "last.*")
    )
    # At most one row per request.
    inside = free.withColumn("slice", hash_bucket(F.col("draw"))).join(
        F.broadcast(last), ["request", "slice"]
    )
    per_draw = inside.groupBy("request", "draw", "below", "free").agg(F.sum("rows").alias("rows"))
    upto = F.col("below") + F.sum("rows").over(group.orderBy("draw"))
    ends = F.when(F.col("upto") >= want, F.struct("draw", (want - F.col("upto") + F.col("rows")).alias("rows")))
    found = (
        per_draw.withColumn("upto", upto)
        .groupBy("request")
        .agg(F.min(ends).alias("end"), F.max("free").alias("free"))
        .collect()
    )
    edges = [_Edge()] * len(wanted)
    for row in found:
        end = row["end"]
        edges[row["request"]] = _Edge(*(end or (_ALL, 0)), row["free"])
    return edges


def _rounds(requests: Sequence[_Request], mixed: bool) -> int:
    """Rounds after which no edge moves: a request waits for the earlier ones that may
    take its rows, and a replay for the main rows it goes with."""
    after: list[int] = []
    for i, request in enumerate(requests):
        waits = (
            after[j]
            for j, other in enumerate(requests[:i])
            if mixed
            or None in (request.language, other.language)
            or request.language == other.language
            or request.phase == other.phase
        )
        after.append(1 + max(waits, default=0))
    return max(after)


def _wanted(requests: Sequence[_Request], edges: Sequence[_Edge], replay_language: str) -> list[int]:
    """Rows that each request asks for, where replays go by the main rows there are."""
    wanted, main = [], {}
    for request, edge in zip(requests, edges):
        rows = request.rows
        if request.role == "main":
            main[request.phase.name] = min(rows, edge.free)
        else:
            rows = request.phase.replay_quota(main.get(request.phase.name, 0), replay_language)
        wanted.append(rows)
    return wanted


def _settled(
    candidates: DataFrame, requests: Sequence[_Request], mixed: bool, replay_language: str
) -> tuple[list[_Edge], list[int]]:
    """The edges of all requests and the rows they ask for, when nothing moves any more."""
    edges, wanted, known = [_Edge()] * len(requests), [r.rows for r in requests], None
    for _ in range(_rounds(requests, mixed)):
        if known:
            wanted = _wanted(requests, edges, replay_language)
        if known == (edges, wanted):
            break
        known = edges, wanted
        edges = _edges(_free(candidates, edges), wanted)
    return edges, wanted


def select_phases(
    pool: DataFrame,
    phases: Sequence[Phase] = PHASES,
    replay_language: str = REPLAY_LANGUAGE,
) -> DataFrame:
    """Selections of all phases in order, none of them sharing an id.

    A row goes to the first request that reaches it. How far each request reaches
    is found in rounds over the small table of candidates: in each, all requests at
    once leave out what the earlier ones took by the round before. The first request
    is right after one round, the next after two at most, and in large pools, where
    few rows are wanted twice, two or three rounds settle all. Contents are joined at the
    end by :func:`with_contents`, for which the result is a written table.
    """
    requests = _requests(phases, replay_language)
    if not requests:
        return pool.sparkSession.createDataFrame([], SELECTION)
    most = 1
    while True:
        candidates, languages, rows = _candidates(pool, requests, most)
        edges, wanted = _settled(candidates, requests, languages > 1, replay_language)
        short = any(
            edge.draw == _ALL or (edge.draw == _NONE and rows_wanted)
            for edge, rows_wanted in zip(edges, wanted)
        )
        # Only where ids repeat: a request may have lost more rows than ids were taken.
        if not short or rows * languages <= most:
            break
        most = rows * languages
    picked = _picked(_free(candidates, edges), edges).select(
        _dealt([r.phase.name for r in requests], F.col("request")).alias("phase"),
        _dealt([r.role for r in requests], F.col("request")).alias("role"),
        "snippet_id",
        "language",
        "row_key",
    )
    salt = F.concat(F.col("phase"), F.lit(" order"))
    return materialise(shuffled(picked, salt, "phase").select(*SELECTION.names), "selection")


def _picked(free: DataFrame, edges: Sequence[_Edge]) -> DataFrame:
    """Rows that the requests take. Of the rows at an edge, which share their key, those of
    the first languages."""
    edge = _dealt([x.draw for x in edges], F.col("request"))
    inside = free.where(F.col("draw") < edge)
    # One key per request: as many rows as it has languages.
    upto = F.sum("rows").over(Window.partitionBy("request").orderBy("language", "row_key"))
    open_rows = _dealt([x.rows for x in edges], F.col("request")) - F.col("upto") + F.col("rows")
    at_edge = free.where(F.col("draw") == edge).withColumn("upto", upto)
    some = at_edge.withColumn("rows", F.least("rows", open_rows)).where("rows > 0").drop("upto")
    copies = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))
    return inside.unionByName(some).select("*", copies.alias("copy"))


def with_contents(selection: DataFrame, pool: DataFrame) -> DataFrame:
    """Selected rows with everything the pool knows of them.

    ``selection`` should be a written table: Spark then knows that it is small,
    and finds its rows without moving the pool. Rows meet by id, or by where they
    came from if they have none. Of pool rows that share an id, a selected row gets
    the first by source and original id, however often the id is selected.
    """
    keyed = pool.withColumn("row_key", row_key(pool)).drop("language", "snippet_id")
    origin = [c for c in ("source_config_id", "original_id", "ord") if c in pool.columns]
    found = selection.join(keyed, "row_key")
    one = Window.partitionBy("phase", "position").orderBy(*(origin or ["row_key"]))
    return found.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").drop("_nth")


def per_phase(phases: Sequence[Phase], value: str) -> Column:
    """A value of the phase descriptors, by the column ``phase``. A phase that is not
    among them fails the job."""
    entries = [F.lit(x) for p in phases for x in (p.name, getattr(p, value))]
    unknown = F.raise_error(F.concat(F.lit("unknown phase: "), F.coalesce("phase", F.lit("null"))))
    if not entries:
        return unknown.cast("int")
    found = F.try_element_at(F.create_map(*entries), F.col("phase"))
    return F.coalesce(found, unknown)


def plan_phases(selection: DataFrame, phases: Sequence[Phase] = PHASES) -> DataFrame:
    """Step plan of every phase."""
    return step_plan(
        split_train_validation(selection),
        per_phase(phases, "epochs"),
        per_phase(phases, "warmup_ratio"),
    )
