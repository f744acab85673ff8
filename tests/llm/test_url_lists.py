import random
import re
from datetime import datetime, timedelta

from snipmill.llm import url_lists as u

DAY = datetime(2024, 1, 1)
CAPTURES = "id bigint, url string, fetched_at timestamp, kind string, value string, month string"
ENTRIES = "list string, kind string, value string, at timestamp, action string, url string"


def captures_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "v", "m") for r in rows], CAPTURES)


def entries_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], ENTRIES)


def covers(kind, value, url):
    found = re.match(r"[a-z]+://([^/?#]+)([^?#]*)", url)
    if not found:
        return False
    host, parts = found[1].lower(), [p for p in found[2].split("/") if p]
    if kind == "domain":
        return host == value or host.endswith("." + value)
    own = [host, *parts]
    wanted = value.split("/")
    return own[: len(wanted)] == wanted


def brute(captures, entries):
    out = []
    for i, url, at in captures:
        active = set()
        for key in {e[:3] for e in entries}:
            log = [e for e in entries if e[:3] == key and at is not None and e[3] <= at]
            last = max(log, key=lambda e: (e[3], e[4])) if log else None
            if last and last[4] == "add" and url and covers(key[1], key[2], url):
                active.add(key)
        out.append((i, bool(active), len(active), min(active) if active else None))
    return sorted(out, key=str)


def judged(spark, captures, entries):
    df = u.judged(captures_of(spark, captures), entries_of(spark, entries))
    rows = [(r.id, r.blocked, r.matches, tuple(r.match) if r.match else None) for r in df.collect()]
    return sorted(rows, key=str)


def test_captures_equal_brute_force(spark):
    draw = random.Random(5)
    hosts = ["a.com", "www.a.com", "x.b.org", "b.org", "c.net"]
    captures = [
        (i, f"http://{draw.choice(hosts)}/{draw.choice(['', 'p', 'p/q', 'pq/'])}?x#y",
         DAY + timedelta(hours=draw.randrange(24 * 400))) for i in range(150)
    ]
    values = [("domain", h) for h in hosts] + [("prefix", "a.com/p"), ("prefix", "x.b.org"), ("prefix", "c.net/p/q")]
    entries = [
        (draw.choice(["l1", "l2"]), *draw.choice(values), DAY + timedelta(days=draw.randrange(400)),
         draw.choice(["add", "remove"])) for _ in range(80)
    ]
    assert judged(spark, captures, entries) == brute(captures, entries)


def test_intervals_at_their_ends_and_ties(spark):
    t = [DAY + timedelta(days=31 * k) for k in range(5)]
    entries = [
        ("l", "domain", "A.com.", t[1], "add"), ("l", "domain", "a.com", t[1], "add"),
        ("l", "domain", "a.com", t[3], "remove"), ("l", "domain", "b.com", t[1], "add"),
        ("l", "domain", "b.com", t[1], "remove"),
    ]
    url = "https://user@Sub.A.com:80/x"
    captures = [(1, url, t[1] - timedelta(seconds=1)), (2, url, t[1]), (3, url, t[3] - timedelta(seconds=1)),
                (4, url, t[3]), (5, "http://b.com/", t[2]), (6, "http://notA.com/", t[2])]
    assert [r[1] for r in judged(spark, captures, entries)] == [False, True, True, False, False, False]


def test_odd_rows(spark):
    captures = [(1, None, DAY), (2, "http://a.com/", None), (3, "no url", DAY), (4, "http://a.com", DAY),
                (4, "http://a.com", DAY), (None, "http://a.com", DAY), (5, "http:///x", DAY), (6, "", DAY)]
    entries = [("l", "domain", "a.com", DAY, "add"), (None, "domain", "a.com", DAY, "add"),
               ("l", "odd", "a.com", DAY, "add"), ("l", "domain", None, DAY, "add"),
               ("l", "domain", "a.com", None, "remove"), ("l", "domain", "a.com", DAY, "odd"),
               ("l", "domain", "", DAY, "add")]
    found = judged(spark, captures, entries)
    assert sorted((str(r[0]), r[1]) for r in found) == sorted(
        [("1", False), ("2", False), ("3", False), ("4", True), ("4", True), ("None", True), ("5", False), ("6", False)]
    )
    assert judged(spark, [], entries) == []
    assert [r[1] for r in judged(spark, captures, [])] == [False] * len(captures)


def test_columns_of_captures_with_names_of_results(spark):
    names = "id bigint, url string, fetched_at timestamp, Matches string, match int, blocked string, own_match int, _url string, _at int, month int, c0 int"
    captures = spark.createDataFrame(
        [(1, "http://a.com/x", DAY, "m", 7, "b", 8, "u", 9, 10, 11), (2, "http://b.com/", DAY, None, None, None, None, None, None, None, None)],
        names,
    )
    found = u.judged(captures, entries_of(spark, [("l", "domain", "a.com", DAY, "add")]))
    assert found.columns == [
        "id", "url", "fetched_at", "own_Matches", "own_own_match", "own_blocked", "own_match", "_url", "_at", "month", "c0",
        "blocked", "matches", "match",
    ]
    one, two = sorted(found.collect())
    assert tuple(one) == (1, "http://a.com/x", DAY, "m", 7, "b", 8, "u", 9, 10, 11, True, 1, ("l", "domain", "a.com"))
    assert tuple(two) == (2, "http://b.com/", DAY, *[None] * 8, False, 0, None)


def test_no_python_in_the_plan(spark):
    df = u.judged(captures_of(spark, [(1, "http://a.com", DAY)]), entries_of(spark, [("l", "domain", "a.com", DAY, "add")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
