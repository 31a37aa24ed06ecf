import random
import re
from datetime import datetime, timedelta

from ontime.llm.url_lists import keys_of, path_depths, verdicts
from pyspark.sql import functions as F

DAY = datetime(2024, 1, 1)


def keys(url):
    m = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)[^/?#]*(/[^?#]*)?", url or "")
    if not m:
        return set()
    host = re.sub(r"\.$", "", m.group(1)).lower()
    labels = host.split(".")
    out = {".".join(labels[i:]) for i in range(max(1, len(labels) - 1))}
    parts = [p for p in (m.group(2) or "").split("/") if p]
    return out | {host + "/" + "/".join(parts[:i + 1]) for i in range(len(parts))}


def plain(captures, changes):
    states = {}
    for name, verdict, key, action, at in changes:
        if None not in (name, verdict, key, action, at):
            moments = states.setdefault((name, verdict, key), {})
            moments[at] = max(moments.get(at, ""), action)
    out = []
    for url, at, extra in captures:
        best = None
        for (name, verdict, key), moments in states.items():
            if at is None or key not in keys(url):
                continue
            past = [t for t in moments if t <= at]
            if past and moments[max(past)] == "add":
                rank = (-len(key), verdict, name, key, max(past))
                best = min(best, rank) if best else rank
        out.append((url, at, extra, best is None or best[1] != "block", *( (best[2], best[3], best[4]) if best else (None, None, None))))
    return sorted(out, key=str)


URLS = ["http://www.a.com/x/y?z", "https://A.com:80/x", "//b.a.com/", "http://user@b.a.com/x/y/", "ftp://c.org", "no url", "", None, "http://localhost/q", "http://a.com."]
CAPTURES = "url string, fetched_at timestamp, kept string"
CHANGES = "list_name string, verdict string, key string, action string, at timestamp, url string"


def make(spark, seed=4, n=300):
    rng = random.Random(seed)
    known = sorted(set().union(*map(keys, URLS)))
    captures = [(rng.choice(URLS), rng.choice([None] + [DAY + timedelta(days=rng.randint(0, 400), hours=rng.choice([0, 5]))] * 9), str(rng.randint(0, 2))) for _ in range(n)]
    changes = [(rng.choice(["l1", "l2"]), rng.choice(["block", "block", "allow"]), rng.choice(known), rng.choice(["add", "remove"]), DAY + timedelta(days=rng.randint(-60, 450), hours=rng.choice([0, 5]))) for _ in range(n)]
    changes += changes[:9] + [(None, "block", "a.com", "add", DAY), ("l1", "block", "a.com", "add", None)]
    return captures, changes


def test_as_of_join_matches_brute_force(spark):
    captures, changes = make(spark)
    left = spark.createDataFrame(captures, CAPTURES)
    right = spark.createDataFrame([(*c, "x") for c in changes], CHANGES)
    got = verdicts(left, right)
    assert got.columns[:3] == ["url", "fetched_at", "kept"] and len(got.columns) == 7
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(captures, changes)


def test_a_path_of_very_many_segments(spark):
    """Only the depths that listed keys have become keys: two here, not twenty thousand."""
    long_path = "http://a.com/" + "/".join(["s"] * 20_000)
    captures = spark.createDataFrame([(long_path, DAY, "x"), ("http://a.com/s", DAY, "x"), ("http://a.com/t/s", DAY, "x")], CAPTURES)
    changes = spark.createDataFrame([("l", "block", key, "add", DAY, "x") for key in ("a.com/s", "a.com/s/s/s")], CHANGES)
    got = {r["url"][:20]: (r[3], r["list_key"]) for r in verdicts(captures, changes).collect()}
    assert got == {long_path[:20]: (False, "a.com/s/s/s"), "http://a.com/s": (False, "a.com/s"), "http://a.com/t/s": (True, None)}
    assert len(captures.select(keys_of(F.col("url"), path_depths(changes)).alias("k")).first()["k"]) == 3


def test_keys(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", keys_of(F.col("u")).alias("k")).collect()
    assert all(set(r.k or []) == keys(r.u) for r in rows)


def test_empty_tables(spark):
    captures, changes = make(spark, n=20)
    left, right = spark.createDataFrame(captures, CAPTURES), spark.createDataFrame([(*c, "x") for c in changes], CHANGES)
    assert verdicts(left.limit(0), right).collect() == []
    assert {r[3] for r in verdicts(left, right.limit(0)).collect()} == {True}
