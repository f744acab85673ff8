"""Samples, replay, phases, splits and batches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from snipmill.functions.hashing import fingerprint
from snipmill.operators.reports import language_distribution
from snipmill.operators.sampling import (
    exclude_used,
    replay_quota,
    replay_sample,
    sample,
    shuffled,
    used_ids,
)
from snipmill.operators.splits import (
    epoch_batches,
    shuffled_place,
    split_train_validation,
    step_plan,
)
from snipmill.plans import phases as phases_module
from snipmill.plans.phases import (
    PHASES,
    Phase,
    per_phase,
    plan_phases,
    select_phases,
    with_contents,
)
from snipmill.session import materialise


def select_phase(pool, phase, used=None):
    """One phase by the plain operators, to compare with."""
    free = pool if used is None else exclude_used(pool, used)
    drawn = sample(free, phase.num_samples, phase.name, phase.language)
    main = materialise(drawn.withColumn("role", F.lit("main")), "main-selection")
    quota = phase.replay_quota(main.count(), "python")
    if not quota:
        return main
    taken = used_ids(main) if used is None else used_ids(main, used)
    replay = replay_sample(pool, taken, quota, f"{phase.name} replay")
    return main.unionByName(replay.withColumn("role", F.lit("replay")))


@pytest.fixture(scope="module")
def pool(spark, tmp_path_factory):
    """2,400 snippets: a third Python, the rest cpp, java and rust."""
    path = str(tmp_path_factory.mktemp("pool"))
    spark.range(2400).select(
        fingerprint(F.col("id").cast("string")).alias("snippet_id"),
        F.when(F.col("id") % 3 == 0, "python")
        .when(F.col("id") % 3 == 1, "cpp")
        .when(F.col("id") % 2 == 0, "java")
        .otherwise("rust")
        .alias("language"),
        F.concat(F.lit("text "), "id").alias("raw_content"),
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_sample_has_the_exact_size_and_is_reproducible(pool):
    first = {r.snippet_id for r in sample(pool, 77, "s", "java").collect()}
    again = {r.snippet_id for r in sample(pool.repartition(7), 77, "s", "java").collect()}
    other = {r.snippet_id for r in sample(pool, 77, "t", "java").collect()}
    assert len(first) == 77 and first == again and first != other
    assert sample(pool, 5000, "s", "rust").count() == 400
    assert sample(pool, 5, "s", "Java").count() == 0
    assert sample(pool, 500, "s").select("language").distinct().count() == 4


def test_rows_without_id_are_never_used_up(spark):
    schema = "snippet_id string, language string, source_config_id string, original_id string"
    pool = spark.createDataFrame(
        [("a", "x", "s", "1"), ("b", "x", "s", "2"), (None, "x", "s", "3"), (None, "x", "s", "4")],
        schema,
    )
    used = spark.createDataFrame([("a",), (None,), ("",)], "snippet_id string")
    left = exclude_used(pool, used)
    assert sorted(r.original_id for r in left.collect()) == ["2", "3", "4"]
    assert sample(left, 2, "s").count() == 2
    assert [r.snippet_id for r in used_ids(used, used).collect()] == ["a"]


def test_replay_quota():
    assert replay_quota(100, "cpp", 0.29) == 28
    assert replay_quota(100, "python", 0.5) == 0
    assert replay_quota(100, None, 0.2) == 20
    assert replay_quota(100, "cpp", 0.0, 7) == 7
    assert replay_quota(0, "cpp", 0.5, 7) == 0


def test_replay_sample_avoids_used_ids(pool):
    used = sample(pool, 750, "u", "python")
    found = replay_sample(pool, used_ids(used), 100, "r")
    assert found.count() == 50
    assert found.join(used, "snippet_id").isEmpty()
    assert found.where("language <> 'python'").isEmpty()


def test_shuffled_numbers_every_group(pool):
    places = shuffled(pool, "s", "language").select("language", "position").collect()
    for language, n in Counter(r.language for r in places).items():
        assert sorted(r.position for r in places if r.language == language) == list(
            range(1, n + 1)
        )


def test_default_phases_give_the_known_plan(pool):
    selection = select_phases(pool).cache()
    rows = selection.collect()
    assert len(rows) == len({r.snippet_id for r in rows}) == 1050
    sizes = Counter((r.phase, r.role) for r in rows)
    assert sizes == {
        ("Python_Focus", "main"): 300,
        ("CPP_Introduction", "main"): 200, ("CPP_Introduction", "replay"): 30,
        ("Java_Introduction", "main"): 200, ("Java_Introduction", "replay"): 20,
        ("Final_Mixed_Tune", "main"): 250, ("Final_Mixed_Tune", "replay"): 50,
    }
    assert {r.language for r in rows if r.role == "replay"} == {"python"}
    plan = {tuple(r) for r in plan_phases(selection).collect()}
    assert plan == {
        ("Python_Focus", 300, 255, 45, 255, 765, 76),
        ("CPP_Introduction", 230, 196, 34, 196, 588, 58),
        ("Java_Introduction", 220, 187, 33, 187, 561, 56),
        ("Final_Mixed_Tune", 300, 255, 45, 255, 510, 51),
    }
    split = split_train_validation(selection)
    batches = epoch_batches(split, per_phase(PHASES, "epochs")).groupBy("phase", "epoch", "part").count().collect()
    assert {r.epoch for r in batches if r.phase == "Final_Mixed_Tune"} == {1, 2}
    assert {r["count"] for r in batches if r.part == "val"} == {45, 34, 33}
    assert with_contents(selection, pool).where("raw_content LIKE 'text %'").count() == 1050
    languages = language_distribution(selection, "phase").collect()
    assert sum(r.n for r in languages) == 1050


def test_phases_equal_one_phase_after_the_other(pool):
    phases = (
        Phase("a", "rust", 300, 1, replay_ratio=0.3),
        Phase("b", "rust", 300, 1, replay_ratio=0.3),
        Phase("c", "rust", 10, 1, replay_ratio=0.3),
        Phase("d", None, 1500, 1, replay_rows=40),
        Phase("e", "python", 900, 1, replay_ratio=0.9),
    )
    found = {
        (r.phase, r.role, r.snippet_id) for r in select_phases(pool, phases).collect()
    }
    wanted, used = set(), None
    for phase in phases:
        chosen = select_phase(pool, phase, used).select("role", "snippet_id")
        wanted |= {(phase.name, *r) for r in chosen.collect()}
        used = used_ids(chosen) if used is None else used_ids(chosen, used)
        used = used.sparkSession.createDataFrame(used.collect(), used.schema)
    assert found == wanted
    assert not [r for r in found if r[0] == "c"]


def test_four_phases_take_at_most_eight_actions(pool, monkeypatch):
    actions = Counter()

    def counted(name):
        plain = getattr(phases_module, name)

        def run(*args):
            actions[name] += 1
            return plain(*args)

        monkeypatch.setattr(phases_module, name, run)

    for name in ("reaching_buckets", "_edges", "materialise"):
        counted(name)
    assert select_phases(pool).count() == 1050
    assert actions["reaching_buckets"] == 1 and actions["materialise"] == 2
    assert sum(actions.values()) <= 8


@pytest.mark.parametrize("copies", [1, 40])
def test_phases_over_repeated_ids(spark, copies):
    """Ids of several languages and with many rows: an id is used up as a whole."""
    rows = [(f"i{k % 110}", ("python", "cpp", "java")[k % 3]) for k in range(330)]
    rows += [(f"j{k}", "python" if k % 2 else "cpp") for k in range(60)]
    rows += [(f"i{k}", "python") for k in range(0, 9, 3) for _ in range(copies - 1)]
    frame = materialise(spark.createDataFrame(rows, "snippet_id string, language string"), "pool")
    phases = (
        Phase("a", "python", 30, 1),
        Phase("b", "cpp", 40, 1, replay_ratio=0.5),
        Phase("c", None, 70, 1, replay_rows=90),
        Phase("d", "java", 200, 1, replay_ratio=1.0),
    )
    found = Counter((r.phase, r.role, r.snippet_id) for r in select_phases(frame, phases).collect())
    wanted, used = Counter(), None
    for phase in phases:
        chosen = select_phase(frame, phase, used).select("role", "snippet_id").collect()
        wanted.update((phase.name, *r) for r in chosen)
        ids = {(r.snippet_id,) for r in chosen} | (set() if used is None else set(map(tuple, used.collect())))
        used = spark.createDataFrame(sorted(ids), "snippet_id string")
    assert found == wanted


def test_first_phase_is_python():
    assert [p.num_samples for p in PHASES] == [300, 200, 200, 250]


@pytest.mark.parametrize("ratio", [0.15, 0.0, 1.0])
def test_split_sizes(spark, ratio):
    sizes = {"n1": 1, "n2": 2, "n6": 6, "n7": 7, "n230": 230}
    rows = [(phase, f"{phase}-{i}") for phase, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "phase string, snippet_id string")
    split = split_train_validation(frame, ratio=ratio)
    found = Counter((r.phase, r.part) for r in split.collect())
    val = {0.15: {"n2": 1, "n6": 1, "n7": 1, "n230": 34}}.get(ratio, {})
    for phase, n in sizes.items():
        assert found[phase, "val"] == val.get(phase, 0)
        assert found[phase, "train"] == n - val.get(phase, 0)


def test_batches(spark):
    frame = spark.createDataFrame(
        [("p", f"{i:03}") for i in range(43)], "phase string, snippet_id string"
    )
    split = split_train_validation(frame)
    rows = epoch_batches(split, 3, 8).collect()
    assert len(rows) == 43 * 3
    orders = []
    for epoch in (1, 2, 3):
        train = [r for r in rows if r.epoch == epoch and r.part == "train"]
        assert Counter(r.batch for r in train) == {0: 8, 1: 8, 2: 8, 3: 8, 4: 5}
        orders.append({r.snippet_id: r.batch for r in train})
    assert orders[0] != orders[1] != orders[2]
    val = {e: {r.snippet_id: r.batch for r in rows if r.epoch == e and r.part == "val"}
           for e in (1, 2, 3)}
    assert val[1] == val[2] == val[3] and len(val[1]) == 6


def test_step_plan_rounds_up_batches(spark):
    frame = spark.createDataFrame(
        [("p", str(i), "train") for i in range(10)] + [("p", "v", "val")],
        "phase string, snippet_id string, part string",
    )
    (row,) = step_plan(frame, F.lit(3), 0.1, batch_size=4).collect()
    assert tuple(row) == ("p", 11, 10, 1, 3, 9, 0)


def test_phases_without_rows_or_ids(spark):
    schema = "snippet_id string, language string, source_config_id string, original_id string, raw_content string"
    rows = [(f"i{k}", "python" if k % 2 else "cpp", "s", str(k), f"t{k}") for k in range(40)]
    rows += [(None, "rust", "s", f"n{k}", f"without {k}") for k in range(30)]
    rows += [("i1", "python", "s", "again", "t1")]
    pool = spark.createDataFrame(rows, schema)
    assert select_phases(pool, ()).count() == 0
    assert plan_phases(select_phases(pool, ()), ()).count() == 0
    phases = (
        Phase("replay only", "cpp", 0, 1, replay_rows=5),
        Phase("rust", "rust", 20, 0, replay_rows=3),
        Phase("none", "go", 5, 2, replay_ratio=0.5),
    )
    chosen = select_phases(pool, phases)
    sizes = Counter((r.phase, r.role) for r in chosen.collect())
    assert sizes == {("replay only", "replay"): 5, ("rust", "main"): 20, ("rust", "replay"): 3}
    contents = with_contents(chosen, pool).collect()
    assert len(contents) == 28
    without = [r.raw_content for r in contents if r.snippet_id is None]
    assert len(without) == len(set(without)) == 20
    split = split_train_validation(chosen)
    assert split.where("phase = 'rust' AND part = 'val'").count() == 3
    batches = epoch_batches(split, per_phase(phases, "epochs")).groupBy("phase").count().collect()
    assert {r.phase: r["count"] for r in batches} == {"replay only": 5}


def test_unknown_phases_and_epochs_fail(spark):
    split = spark.createDataFrame(
        [("p", "a", "train", 1)], "phase string, snippet_id string, part string, place int"
    )
    for epochs in (per_phase(PHASES, "epochs"), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="unknown phase|number of epochs"):
            epoch_batches(split, epochs).count()
    assert epoch_batches(split, 0).count() == 0


def test_shuffled_places_are_a_permutation(spark):
    """For any size, another one each epoch, and spread over all places."""
    rows = [(m, i) for m in (1, 2, 3, 5, 64, 1000) for i in range(m)]
    df = spark.createDataFrame(rows, "m bigint, i bigint").withColumn("e", F.explode(F.array(F.lit("1"), F.lit("2"))))
    found = {}
    for r in df.withColumn("p", shuffled_place(F.col("i"), F.col("m"), F.col("e"))).collect():
        found.setdefault((r.m, r.e), {})[r.i] = r.p
    for (m, _), places in found.items():
        assert sorted(places.values()) == list(range(m))
    assert found[1000, "1"] != found[1000, "2"]
    for e in ("1", "2"):
        p = found[1000, e]
        assert sum(p[i] == i for i in p) < 10 and sum(abs(p[i + 1] - p[i]) == 1 for i in range(999)) < 15
        quarters = [sum(p[i] // 250 == q for i in range(250)) for q in range(4)]
        assert min(quarters) > 35


def test_epochs_need_no_exchange(spark, tmp_path):
    split = spark.createDataFrame([("a", "x", "train", 1, 1)], "phase string, snippet_id string, part string, place int, of int")
    plan = epoch_batches(split, 3, 8)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
