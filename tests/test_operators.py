import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mergewell.operators import candidates, components, consolidate, gold, records
from mergewell.session import DELETE_SHUFFLES, cut_lineage, cut_scan

PERSON = "id string, full_name string, cedula_hmac string, identity_kind string, cedula_partial string, cedula_partial_pattern string, last_known_location string, age_range struct<min:int,max:int>, status string, block_keys array<string>"


def person(i, name, hmac=None, keys=("k",), place="Chacao, Miranda", kind="none", partial=None):
    return (i, name, hmac, kind, partial, partial and "suffix_4", place, (30, 40), "missing", list(keys))


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(1)
    chain = list(range(300))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, k) for k in range(1001, 1200)] + [(7, 7), (5000, 5001), (5001, 5000)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {got[k] for k in range(300)} == {0} and {got[k] for k in range(1000, 1200)} == {1000} and got[5001] == 5000 and len(got) == 502
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_winner_does_not_depend_on_order(spark):
    rows = [("a", "h", "B", "2024-01-02", "0.9", "1", "s"), ("b", "h", "A", "2024-01-01", None, "2", "s"), ("c", "h", "A", "2024-01-03", "x", "3", "s"), ("d", "h", "A", "bad", "1", "0", "s"), ("e", "", "A", None, None, "0", "s"), ("f", None, "A", None, None, "0", "s")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = consolidate.pick_winners(spark.createDataFrame(rows, "id string, dedup_hash string, trust_tier string, fetched_at string, confidence_score string, created_at string, source_id string")).collect()
        assert [(r["id"], r["group_size"]) for r in got] == [("c", 4)]


def test_upsert_twice_is_upsert_once(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, keep string")
    new = spark.createDataFrame([(2, "c", "z"), (3, None, "w")], "k int, v string, keep string")
    once = consolidate.upsert(old, new, ["k"], ("keep",))
    assert sorted(once.collect()) == sorted(consolidate.upsert(once, new, ["k"], ("keep",)).collect()) == [(1, "a", "x"), (2, "c", "y"), (3, None, "w")]


def test_candidates(spark):
    people = [person("a", "Ana Díaz", "h1", ("ced:h1", "phon:x")), person("b", "Ana Diaz", "h1", ("ced:h1", "phon:x")), person("c", "Ana Diaz", "h2", ("phon:x",)), person("d", None, None, ("phon:x", "phon:x")), person(" ", "Ana Diaz", "h1", ("ced:h1",))]
    got = candidates.find_candidates(spark.createDataFrame(people, PERSON)).collect()
    assert [(r["left_id"], r["right_id"], r["blocking_key"]) for r in sorted(got)] == [("a", "b", "ced:h1"), ("a", "b", "phon:x")]
    assert {r["score"] for r in got} == {1.0} and {r["priority"] for r in got} == {2} and got[0]["reasons"]["name"] == 0.4


def test_bound_loses_no_pair(spark):
    rng = random.Random(2)
    people = [person(f"{i:03}", " ".join(rng.choice(["ana", "luis", "mora", "diaz"]) for _ in range(2)), rng.choice([None, "h1", "h2"]), ("k",), rng.choice(["A, B", "C, B", "D"]), "partial", rng.choice(["12", "34"])) for i in range(40)]
    df = spark.createDataFrame(people, PERSON)
    every = candidates.find_candidates(df, 0.0001).where("score >= 0.85").count()
    assert every == candidates.find_candidates(df).count() > 0


def test_a_common_name_or_number_makes_no_pairs_that_fail(spark):
    """A block of one name, or of one partial number with different places, has no pair that can reach the threshold, so none is made."""
    same = [person(f"n{i:03}", "Ana Díaz", keys=("phon:ana",)) for i in range(200)]
    partial = [person(f"p{i:03}", "Ana Díaz", keys=("part:12",), place=f"Chacao, E{i}", kind="partial", partial="12") for i in range(200)]
    full = [person(f"f{i}", "Ana Díaz", "h", ("ced:h",)) for i in range(3)]
    assert candidates._pairs(spark.createDataFrame(same + partial + full, PERSON), None, 0.85).count() == 3


def test_pairs_that_can_reach_the_threshold_are_all_made(spark):
    """Against all pairs of the blocks, with names so long that they differ and still count, and for new records alone."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["ana", "luis", "mora", "diaz"]) for _ in range(600))
    names = [long, long[:1500] + "x" + long[1501:], long[:900] + long[901] + long[900] + long[902:], "ana mora", "ana moras", "", None]
    people = [person(f"{i:03}", rng.choice(names if i < 12 else names[3:]), rng.choice([None, None, "h1", "h2"]), ("k", "l") if i % 3 else ("k",), rng.choice(["A, B", "C, B", "D"]) if i >= 12 else "A, B", rng.choice(["partial", "none"]) if i >= 12 else "partial", rng.choice(["12", "34"]) if i >= 12 else "12") for i in range(60)]
    df = spark.createDataFrame(people, PERSON)
    new = df.where("id < '030'").select("id")
    for ids in (None, new):
        edges = lambda least: sorted((r["left_id"], r["right_id"], r["blocking_key"], r["score"]) for r in candidates.find_candidates(df, least, ids).collect() if r["score"] >= 0.85)
        want = edges(0.0001)
        assert edges(0.85) == want and len({w[:2] for w in want}) > 20
        lengths = {p[0]: p[1] for p in people}
        assert any(lengths[a] != lengths[b] and len(lengths[a]) > 800 for a, b, *_ in want)


def test_equal_records_are_scored_as_one(spark, monkeypatch):
    """Copies make one pair of groups, not one for each two of them, and lose none of their edges; also where their group is divided, and for new records alone."""
    people = [person(f"{i:03}", ["Ana Díaz", "Ana Dias", "Luis Mora"][i % 3], "h", ("ced:h",)) for i in range(90)]
    df = spark.createDataFrame(people, PERSON)
    assert candidates._group_pairs(df, None, 0.85).count() <= 9
    alike = lambda a, b: {int(a) % 3, int(b) % 3} != {0, 2} and {int(a) % 3, int(b) % 3} != {1, 2}
    want = {(f"{i:03}", f"{j:03}") for i in range(90) for j in range(i + 1, 90) if alike(i, j)}
    for most in (1000, 7):
        monkeypatch.setattr(candidates, "HOT_BLOCK", most)
        got = [(r["left_id"], r["right_id"]) for r in candidates.find_candidates(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        got = [(r["left_id"], r["right_id"]) for r in candidates.find_candidates(df, new_ids=df.where("id in ('004', '010', '050')").select("id")).collect()]
        assert len(got) == len(set(got)) and set(got) == {w for w in want if {"004", "010", "050"} & set(w)}


def test_a_merge_deals_its_edges_once(spark):
    """Found and existing edges, doubled and lacking ones too, meet in one exchange and without a join."""
    edge = "left_id string, right_id string, blocking_key string, score double, reasons map<string,double>, priority int"
    found = spark.createDataFrame([("a", "b", "k", 0.9, {"name": 0.4}, 1), ("b", "a", "k", 0.9, {"name": 0.4}, 1), ("a", "c", "k", 0.95, {}, 2), (None, "c", None, 0.9, {}, 1)], edge)
    old = spark.createDataFrame([("b", "a", "k", 0.1, {}, 1, "rejected"), ("a", "b", "k", 0.2, {}, 1, "accepted"), ("a", "b", "other", 0.3, {}, 2, None), (None, "c", None, 0.4, {}, 1, "rejected")], edge + ", decision string")
    merged = candidates.merge_candidates(old, found)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = sorted((str(r["left_id"]), r["right_id"], str(r["blocking_key"]), r["score"], r["priority"], r["decision"], len(r["reasons"])) for r in merged.collect())
    assert got == [("a", "b", "k", 0.9, 1, "accepted", 1), ("a", "b", "other", 0.3, 2, "pending", 0), ("a", "c", "k", 0.95, 2, "pending", 0), ("b", "a", "k", 0.9, 1, "rejected", 1), ("c", "c", "None", 0.4, 1, "rejected", 0), ("c", "c", "None", 0.9, 1, "pending", 0)]


def test_new_against_old_only(spark):
    df = spark.createDataFrame([person(i, "Ana", "h") for i in "abc"], PERSON)
    got = candidates.find_candidates(df, new_ids=df.where("id = 'c'").select("id")).collect()
    assert sorted((r["left_id"], r["right_id"]) for r in got) == [("a", "c"), ("b", "c")]


def test_decisions_survive(spark):
    found = candidates.find_candidates(spark.createDataFrame([person(i, "Ana", "h") for i in "ab"], PERSON))
    old = found.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "blocking_key", F.lit(0.1).alias("score"), "reasons", "priority", F.lit("rejected").alias("decision"))
    got = candidates.merge_candidates(old, found).collect()
    assert [(r["decision"], r["score"]) for r in got] == [("rejected", 1.0)]


def test_gold_keeps_ids_and_publishes_orphans(spark):
    edges = spark.createDataFrame([("b", "c", "ced:1", "pending"), ("c", "d", "phon:1", "accepted"), ("a", "b", "ced:2", "rejected"), ("e", "f", "phon:2", "pending")], "left_id string, right_id string, blocking_key string, decision string")
    rows = spark.createDataFrame([(i, "A", None, 0.5, "1", "s") for i in "abcdef"], "id string, trust_tier string, fetched_at string, confidence_score double, created_at string, source_id string")
    entities, members, history = gold.gold_tables(rows, gold.clusters(edges), spark.createDataFrame([("d", "old")], "id string, gold_id string"))
    assert [tuple(r) for r in entities.collect()] == [("old", "b", 3)] and history.first()["action"] == "merge"
    assert sorted(r["id"] for r in gold.published(rows, entities, members).collect()) == ["a", "b", "e", "f"]


def test_person_rules(spark):
    schema = "full_name string, fuente string, event_id string, status string, identity_kind string, pii_provenance string, trust_tier string, confidence_score double, cedula_masked string, cedula_partial string, cedula_partial_pattern string, cedula_hmac string, age_range struct<min:int,max:int>"
    event = "11111111-1111-4111-8111-111111111111"
    rows = [("A", "f", event, "missing", "none", "cleartext", "a", 1.0000000001, None, None, None, None, None), (" ", None, "x", "odd", "hmac", "odd", "Z", 2.0, "", "1", "odd", None, (5, 1)), ("A", "f", event, "missing", "partial", "cleartext", "A", None, None, "12", "suffix_2", None, (1, 2))]
    df = spark.createDataFrame(rows, schema)
    good, bad = records.split_valid(df, records.broken_person_rules())
    assert good.count() == 2 and set(bad.first()["broken_rules"]) == {"full_name", "fuente", "event_id", "status", "pii_provenance", "trust_tier", "confidence_score", "cedula_masked", "cedula_partial", "cedula_partial_pattern", "age_range", "hmac_without_value", "value_without_partial"}


def test_tokenise_and_quarantine(spark):
    df = spark.createDataFrame([("", "V-12345678", "s", "llame al 0414-1234567")], "cedula string, documento string, source_slug string, body string")
    got = records.tokenise_identifiers(df, {"cedula": ("cedula", "documento")}, "k")
    assert set(got.columns) == {"source_slug", "body", "cedula_hmac", "cedula_masked"} and got.first()["cedula_masked"] == "****5678"
    row = records.quarantine_rows(df, "body", "pii_untreatable", "high").first()
    assert "1234567" not in row["payload_preview_redacted"] and row["pii_findings_summary"] == {"phone": 1}
    with pytest.raises(ValueError):
        records.quarantine_rows(df, "body", "unknown", "high")


def test_checkpoints_leave_no_shuffle_files(spark):
    """The frames stay referenced, so no garbage collection deletes the files for them."""
    folders = [Path(f.getPath()) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for folder in folders for f in folder.rglob("shuffle_*")}

    before, setting, began = files(), spark.conf.get(DELETE_SHUFFLES, "false"), time.time()
    ids = spark.range(1000)
    grouped = ids.groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    joined = grouped.join(ids.groupBy((F.col("id") % 11).alias("k")).agg(F.max("id").alias("most")), "k")
    cuts = [cut_lineage(grouped), cut_lineage(joined, 7), cut_scan(ids, ids)]
    while (left := files() - before) and time.time() < began + 30:  # they are deleted in the background
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(DELETE_SHUFFLES, "false") == setting
    for _ in range(2):
        assert [c.count() for c in cuts] == [7, 7, 1000] and sorted(cuts[1].collect()) == sorted(joined.collect()) and grouped.count() == 7
