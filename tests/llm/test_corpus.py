"""Every corpus operator against a plain version, and on rows that are null, empty, very long, tied, repeated or missing."""

import os
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergewell.llm import chat, decontaminate, hosts, line_templates, near_dup, quality, queries, sharding, spots, stages, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, th string"
WORDS = [a + b + c for a in ("ba", "ko", "ri", "su") for b in ("la", "mo", "ne", "ti") for c in ("x", "nd", "st", "r")]


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (" the" if rng.random() < 0.2 else "") for _ in range(n))


def rows(texts, ids=None):
    return [(i, t, "en", "s", None, 1.0, "fp", "th") for i, t in zip(ids or range(len(texts)), texts)]


ODD = [None, "", " \t ", "\n\n", "a", "the", prose(1), prose(1), prose(2, 30_000), "x" * 50_000, prose(3), "ÉÑ 漢字 \u0000 ▁ 9.5 km", prose(4) + "\n" + prose(5)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(ODD) + rows([ODD[6], "z", None], [6, None, None]), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, n=0):
    return spark.createDataFrame([(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(n)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def plain_bins(table, expected):
    return sorted(table.collect()) == sorted(expected)


# 1 and 3


def labelled(spark, toxic=False):
    good, bad = [prose(i, 80) for i in range(200)], []
    for i in range(200):
        words = prose(1000 + i, 80).split()
        if toxic:
            for k in range(0, 80, 10):
                words[k] = random.Random(i + k).choice(["zwaxig", "plurgox"])
            bad.append(" ".join(words))
        else:
            bad.append(" ".join(w.upper() + "!!" for w in words))
    docs = spark.createDataFrame(rows(good + bad), SCHEMA)
    lab = spark.createDataFrame([(i, int(i < 200), int(i >= 200)) for i in range(400)], "doc_id long, quality int, toxic int")
    return docs, lab


@pytest.mark.parametrize("train,label,toxic", [(quality.train_quality, "quality", False), (toxicity.train_toxicity, "toxic", True)])
def test_classifiers_tell_held_out_rows(spark, train, label, toxic):
    docs, lab = labelled(spark, toxic)
    got = {r["doc_id"]: r["score"] for r in quality.score_texts(docs, train(docs, lab)).collect()}
    held = [(got[r["doc_id"]] >= 0.5) == bool(r[label]) for r in lab.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 40 and np.mean(held) > 0.95


@pytest.mark.parametrize("train", [quality.train_quality, toxicity.train_toxicity])
def test_classifiers_without_labels_and_on_odd_rows(spark, odd, empty, train):
    model = train(odd, labels(spark))
    scored = quality.score_texts(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score_texts(empty, train(empty, labels(spark))).count() == 0


def test_toxic_stage_drops_toxic_rows_only(spark):
    docs, lab = labelled(spark, True)
    kept = {r["doc_id"] for r in stages.drop_toxic(docs, lab).collect()}
    assert len(kept & set(range(200))) > 195 and len(kept & set(range(200, 400))) < 10


# 2


def test_shards_are_near_equal_and_gapless_with_a_hot_text(spark):
    texts = [prose(i, 10 + i % 50) for i in range(600)] + ["copy of one text"] * 400
    got = sharding.shard(spark.createDataFrame(rows(texts), SCHEMA), 8).toPandas()
    assert len(got) == 1000 and set(got.shard) == set(range(8)) and got.grown_shard.isna().all()
    size = got.groupby("shard")["size"].sum()
    assert size.max() - size.min() <= 2 * got["size"].max() + 20
    assert all(sorted(s.slot) == list(range(len(s))) for _, s in got.groupby("shard"))
    crc = {i: zlib.crc32(t.encode()) for i, t in enumerate(texts)}
    assert all(crc[i] == c and z == len(texts[i]) + 1 for i, c, z in zip(got.doc_id, got.text_crc32, got["size"]))


def test_shards_of_odd_rows(odd, empty):
    got = sharding.shard(odd, 4).toPandas()
    assert len(got) == odd.count() and (got["size"] >= 1).all() and sorted(got.groupby("shard").slot.min()) == [0] * got.shard.nunique()
    assert sharding.shard(empty).count() == 0


def test_histogram_counts_exactly(spark):
    keys = sharding.measured(spark.createDataFrame(rows([prose(i) for i in range(100)]), SCHEMA))
    known = sorted((r["k1"], r["k2"], r["k3"], r["size"]) for r in keys.collect())
    probes = [k[:3] for k in known[10::20]]
    sizes, counts = sharding.histogram(keys, probes)
    assert list(counts[:-1]) == [10, 30, 50, 70, 90] and list(sizes[:-1]) == [sum(k[3] for k in known[:n]) for n in (10, 30, 50, 70, 90)]


def test_splitters_equal_plain_cuts_and_repeats_are_divided(spark):
    docs = spark.createDataFrame(rows([prose(i, 5 + i % 90) for i in range(400)]), SCHEMA).repartition(3)
    keys = sharding.cut_lineage(sharding.measured(docs))
    known = sorted((r["k1"], r["k2"], r["k3"], r["size"]) for r in keys.collect())
    below = np.cumsum([0] + [k[3] for k in known])
    for j, key in enumerate(sharding.find_splitters(keys, 8), 1):
        at = [k[:3] for k in known].index(key)
        assert abs(below[at] - below[-1] * j / 8) <= np.abs(below - below[-1] * j / 8).min() + sharding.TOLERANCE * below[-1] / 8
    equal = spark.createDataFrame(rows(["one text of some length"] * 1000 + ["x"] * 100, [7] * 1000 + list(range(100))), SCHEMA)
    got = sharding.shard(equal).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 16 and size.max() - size.min() <= 48 and all(sorted(s.slot) == list(range(len(s))) for _, s in got.groupby("shard"))


# 4


def test_templates_catch_reparameterised_items_and_leave_clean_texts(spark):
    item = "if Anna buys 12 kg of flour and sells 5 kg to Bruno how much flour does Anna keep for the long winter months ahead"
    changed = item.replace("Anna", "Clara").replace("Bruno", "Dario").replace("12", "70").replace("5 kg", "8 kg")
    broken = changed.replace("does Clara", "does Ernst")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, item)], "item_id long, text string")
    docs = spark.createDataFrame(rows([prose(1) + " " + item, prose(2) + " " + changed + " " + prose(3), broken, prose(4), None, item[:60]]), SCHEMA)
    got = {r["doc_id"]: r for r in decontaminate.decontamination_report(docs, bench).collect()}
    assert [got[i]["contaminated"] for i in range(6)] == [True, True, False, False, False, False]
    same = {r["same_slots"] for r in decontaminate.contaminated_texts(docs, bench).collect()}
    assert same == {True, False}
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()) == [2, 3, 4, 5]


def flagged(spark, item, texts):
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    report = decontaminate.decontamination_report(spark.createDataFrame(rows(texts), SCHEMA), bench)
    return [r["contaminated"] for r in sorted(report.collect())]


ITEM = "if Anna buys 12 kg of flour and sells 5 kg to Bruno how much flour does Anna keep for the long winter months ahead"


def test_items_match_whatever_their_case(spark):
    texts = [f(prose(1) + " " + ITEM + " " + prose(2)) for f in (str.upper, str.title, str.lower)]
    assert flagged(spark, ITEM, texts + [prose(1).upper()]) == [True, True, True, False]


def test_items_match_with_longer_slots_and_inserted_words(spark):
    longer = ITEM.replace("Bruno", "Bruno Rossi").replace("12", "1 200")
    inserted = ITEM.replace("the long", "the very long")
    broken = longer.replace("does Anna", "does Ernst")
    scattered = " ".join(ITEM.split()[:11]) + " " + prose(5) + " " + " ".join(ITEM.split()[11:])
    texts = [prose(i) + " " + t + " " + prose(i + 9) for i, t in enumerate([longer, inserted, broken, scattered])]
    assert flagged(spark, ITEM, texts) == [True, True, False, False]


def test_only_slots_of_matched_windows_count(spark):
    item = "take 12 drops of the oil each day " + prose(8, 30) + " and end with 12 steps"
    copies = [item.replace("with 12 steps", "with ten more"), item.replace("with 12 steps", "and nothing else"), item.replace("12", "40")]
    assert flagged(spark, item, [prose(1) + " " + c + " " + prose(2) for c in copies]) == [True, True, True]


def test_short_items_match_whole_texts_only(spark):
    assert flagged(spark, "What is two?", ["what IS two", "I ask what is two", None, "", "what is three"]) == [True, False, False, False, False]
    assert flagged(spark, "Paris Is The Capital Of France And Lyon Is Not", [prose(3) + " Paris Is The Capital Of France And Lyon Is Not " + prose(4), prose(5)]) == [True, False]
    assert flagged(spark, "", ["", "a"]) == [False, False]


def test_recall_of_generated_variants(spark):
    rng, names, texts = random.Random(6), ["Clara", "Dario", "Ernst", "Fatima Rossi", "Goran"], []
    for _ in range(40):
        a, b = rng.sample(names, 2)
        text = ITEM.replace("Anna", a).replace("Bruno", b).replace("12", str(rng.randint(20, 9000))).replace("5 kg", f"{rng.randint(2, 19)} kg")
        texts.append(prose(rng.randint(0, 99)) + " " + text + " " + prose(rng.randint(0, 99)))
    assert np.mean(flagged(spark, ITEM, texts)) >= 0.95


def test_first_step_loses_no_match(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    pieces = bench.select((F.col("item_id") + 10**6).alias("doc_id"), F.expr("concat_ws(' ', 'start here', array_join(slice(split(text, ' '), 3, 60), ' '), 'end')").alias("text"))
    every = docs.select("doc_id", "text").unionByName(pieces)
    found = lambda: sorted(r["doc_id"] for r in decontaminate.decontamination_report(every, bench).where("contaminated").collect())
    kept = found()
    monkeypatch.setattr(decontaminate, "_possible_texts", lambda keyed, *_: decontaminate._kinds(keyed.dropDuplicates(["th"]), "th"))
    assert kept == found() and len(kept) > 20


def test_decontamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, prose(3))], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontamination_report(odd, bench).where("contaminated").count() == 1
    assert decontaminate.drop_contaminated(odd, none).count() == odd.count()
    assert decontaminate.drop_contaminated(empty, bench).count() == 0


# 5


def test_hosts(spark):
    urls = ["http://A.Example.ORG/es/x?q", "https://x.org", "https://x.org/p#f", "http://b.com/de/1", "http://b.com/fr/", "ftp://bad.net/x", None, "nothing", "http://good.net", "http://example.org/en/1"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(100 + i, "http://bad.net/q") for i in range(30)] + [(200 + i, "http://good.net/q") for i in range(30)], "page_id long, url string")
    lab = spark.createDataFrame([(100 + i, 0, 1) for i in range(30)] + [(200 + i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in hosts.judge_pages(pages, lab).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(10)] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("x.org", "", None, "allow"), ("x.org", "/p", "org/", "allow"), ("b.com", "/de/1", "com/de/", "block"), ("b.com", "/fr/", "com/fr/", "allow"),
        ("bad.net", "/x", None, "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("good.net", "", None, "allow"), ("example.org", "/en/1", "example.org/en/1", "block"),
    ]
    assert hosts.judge_pages(pages.limit(0), lab).count() == 0 and hosts.judge_pages(pages, lab.limit(0)).count() == 70


# 6


def brute_components(fps):
    distinct = sorted(set(fps))
    group = {f: f for f in distinct}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
                group[find(a)] = find(b)
    return {f: find(f) for f in distinct}


@pytest.mark.parametrize("star_from", [4096, 1])
def test_links_equal_brute_force(spark, star_from, monkeypatch):
    monkeypatch.setattr(near_dup, "STAR_FROM", star_from)
    rng = random.Random(star_from)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for f in list(fps[:20]):
        for _ in range(6):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps.append(f)
    signed = sorted({f - 2**64 if f >= 2**63 else f for f in fps})
    edges = near_dup.links(spark.createDataFrame([(f,) for f in signed], "fp long"), len(signed)).collect()
    want = brute_components(signed)
    assert all(bin((e["a"] ^ e["b"]) & (2**64 - 1)).count("1") <= 3 for e in edges)
    group = {f: f for f in signed}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    for e in edges:
        group[find(e["a"])] = find(e["b"])
    classes = lambda m: {frozenset(f for f in signed if m(f) == c) for c in {m(f) for f in signed}}
    assert classes(find) == classes(want.get)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = near_dup.near_duplicates(odd).toPandas()
    assert len(got) == odd.count()
    zero = got[got.fp == 0]
    assert len(zero) == 5 and set(zero.component_id) == {0}
    assert set(got[got.doc_id.isin([6, 7])].component_id) == {6}
    assert near_dup.near_duplicates(empty).count() == 0
    kept = near_dup.keep_first(odd, 5)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == odd.columns and 6 in ids and 7 not in ids and len(ids) == len(set(ids))
    assert near_dup.keep_first(empty).count() == 0


def jaccard_firsts(texts, width=5, least=0.8):
    """Plain Python: the first of each class of texts that share `least` of their shingles."""
    split = [t.lower().split() for t in texts]
    sets = [{" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} for w in split]
    group = list(range(len(texts)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= least * len(a | sets[j]):
                low, high = sorted((find(i), find(j)))
                group[high] = low
    return {i for i in range(len(texts)) if find(i) == i}


@pytest.mark.parametrize("stars", [3, 0])
def test_kept_documents_equal_plain_jaccard(spark, stars, monkeypatch):
    monkeypatch.setattr(near_dup, "STARS", stars)
    texts = []
    for i in range(12):
        words = prose(500 + i, 300).split()
        for changes in (0, 2, 4, 5, 6, 7, 9, 30):
            copy = list(words)
            for k in range(changes):
                copy[(k * len(copy)) // changes + i] = f"new{k}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(rows(texts + ["a b", "A  b", "a c"]), SCHEMA).repartition(3)
    want = jaccard_firsts(texts + ["a b", "A  b", "a c"])
    assert {r["doc_id"] for r in near_dup.keep_first(docs, 5).collect()} == want and 12 < len(want) < len(texts)


def test_near_dedup_takes_candidates_from_simhash(spark, monkeypatch):
    """Without a common min-hash key, copies within three bits still meet through their fingerprints; those below JACCARD stay."""
    monkeypatch.setattr(near_dup, "bands_of", lambda x: np.frombuffer(os.urandom(8 * 24), np.uint64))
    words = prose(77, 2000).split()
    texts = [" ".join(words), " ".join([*words[:900], "changed", *words[901:]]), " ".join(words + words), prose(78, 2000)]
    marks = [near_dup.fingerprint_of(t.encode(), 5) for t in texts]
    assert 0 < (marks[0] ^ marks[1]).bit_count() <= 3 < (marks[0] ^ marks[3]).bit_count()
    assert sorted(r["doc_id"] for r in near_dup.keep_first(spark.createDataFrame(rows(texts), SCHEMA), 5).collect()) == [0, 3]


# 7


def test_recurring_lines_go_but_where_they_come_first(spark):
    long = prose(99, 60)
    varied = [f"alpha beta gamma delta epsilon zeta eta theta id{k} kappa" for k in range(4)]
    swapped = ["one two three four five six seven eight nine " + w for w in ("ten", "eleven", "twelve", "dozen")]
    texts = ["\n".join([prose(i, 20), varied[i], swapped[i]] + ([long] if i > 1 else [])) for i in range(4)] + ["\n".join([prose(0, 20), varied[0], swapped[0]]), "hi\nhi", "hi", "hi"]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    cleaned, _ = line_templates.drop_recurring_lines(docs)
    got = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert got[0] == texts[0] and got[4] == texts[4] and got[1] == prose(1, 20)
    assert got[2] == prose(2, 20) + "\n" + long and got[3] == prose(3, 20)
    assert [got[i] for i in (5, 6, 7)] == ["hi\nhi", "hi", "hi"] and cleaned.columns == docs.columns


def test_every_template_of_a_leaf_is_found(spark):
    lines = [[f"alpha beta gamma {' '.join(f't{chr(97 + t)}{chr(97 + k)}x' for k in range(6))} end{chr(97 + v)}" for v in range(6)] for t in range(10)]
    texts = ["\n".join([prose(700 + v, 20)] + [lines[t][v] for t in range(10)]) for v in range(6)]
    cleaned, _ = line_templates.drop_recurring_lines(spark.createDataFrame(rows(texts), SCHEMA))
    got = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert got == {0: texts[0]} | {v: prose(700 + v, 20) for v in range(1, 6)}
    assert len(line_templates.line_templates(spark.createDataFrame(rows(texts), SCHEMA))[0].collect()) == 10


def test_index_of_seeds_equals_plain_rounds(monkeypatch):
    rng = np.random.default_rng(5)
    for n in (5, 9, 10, 23):
        base = rng.integers(0, 9, (12, n)).astype(np.int32)
        base[:, :3] = 0
        forms = base[rng.integers(0, 12, 300)]
        for row in forms:
            row[3 + rng.integers(0, n - 3, n // 5)] = rng.integers(0, 9)
        forms = np.unique(forms, axis=0)
        forms = forms[rng.permutation(len(forms))]
        monkeypatch.setattr(line_templates, "DIRECT", 0)
        indexed = line_templates.gathered(forms)
        monkeypatch.setattr(line_templates, "DIRECT", 10**6)
        assert (indexed == line_templates.gathered(forms)).all()


def test_line_dedup_of_odd_rows(odd, empty):
    got = line_templates.line_report(odd).toPandas()
    assert len(got) == odd.count() and got.text_sha256.isna().sum() == 2 and got[got.text_sha256.isna()].n_lines.tolist() == [0, 0]
    assert line_templates.drop_recurring_lines(empty)[0].count() == 0


def test_leaves_of_any_size_have_the_same_templates(spark, monkeypatch):
    """Several tasks with a few lines each assign what `gathered` does with the whole leaf at once."""
    rng = np.random.default_rng(5)
    leaves, n = {}, 12
    for leaf, m in enumerate((150, 90, 40, 7)):
        bases = rng.integers(-9, 9, (6, n)).astype(np.int32)
        forms = bases[rng.integers(0, len(bases), m)]
        for row in forms:
            where = rng.choice(np.arange(3, n), rng.integers(0, 5), replace=False)
            row[where] = rng.integers(100, 140, len(where))
        forms[:, :3] = leaf
        forms = np.unique(forms, axis=0)
        rng.shuffle(forms)
        h = rng.choice(10**6, len(forms), replace=False) - 500_000 + leaf * 10**7
        docs = np.sort(rng.integers(1, 4, len(forms)))[::-1]
        order = np.lexsort((h, -docs))
        leaves[leaf] = (h[order], docs[order], forms[order])
    frame = spark.createDataFrame([(int(a), leaf, [int(x) for x in f], int(d)) for leaf, (h, docs, forms) in leaves.items() for a, d, f in zip(h, docs, forms)], "h long, leaf long, tokens array<int>, docs long").repartition(3)
    want, steps = {}, [0, 0]
    for h, docs, forms in leaves.values():
        owner = line_templates.gathered(forms)
        want |= {int(h[i]): int(h[o]) for i, o in enumerate(owner) if i != o}
        steps[0] += (owner != line_templates._led(forms)).sum()
    assert steps[0] > 2
    for most in (16, 1000):
        monkeypatch.setattr(line_templates, "LEAF_FORMS", most)
        got = [tuple(r) for r in line_templates._gathered_apart(frame, 300).collect()]
        assert dict(got) == want and len(got) == len(want)


def test_a_field_of_few_values_divides_no_template(spark, monkeypatch):
    monkeypatch.setattr(line_templates, "LEAF_FORMS", 10)
    texts = [f"alpha beta gamma delta epsilon {a} zeta {b} eta theta" for b in "pqrstuvw" for a in ("left", "right")]
    cleaned, _ = line_templates.drop_recurring_lines(spark.createDataFrame(rows(texts), SCHEMA))
    assert sorted(r["text"] for r in cleaned.collect()) == [""] * 15 + [texts[0]]


# 8


def test_spot_signatures_and_edits(spark, odd, empty):
    got = {r["doc_id"]: r for r in spots.edited_fingerprints(odd.dropDuplicates(["doc_id"]).where("doc_id is not null"), 5).collect()}
    n = len(ODD)
    assert len(got) == n
    for i in range(n):
        own, after = ODD[i] or "", ODD[(i - 1) % n] or ""
        third = len(own) // 3
        edited = own[: len(own) - third] + after[:third]
        a, b, c = (spots.signatures(t.encode()) for t in (own, edited, after))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(own), sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spots.packed(a), spots.packed(b))
        assert r["near_edited"] == spots.likeness(a, b) and r["near_next"] == spots.likeness(a, c)
    assert got[6]["fingerprint"] == got[7]["fingerprint"] and spots.edited_fingerprints(empty).count() == 0
    assert spots.edited_fingerprints(odd).count() == odd.count()


def test_similar_documents_equal_brute_force(spark):
    texts = [prose(i, 120) for i in range(25)]
    texts += [t.replace(" the", " the", 1) + " end" for t in texts[:8]] + [texts[0], ""]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    classes, linked = spots.similar_documents(docs, least=0.7)
    sets = [spots.signatures(t.encode()) for t in texts]
    member = {r["doc_id"]: r["component_id"] for r in classes.collect()}
    for i in range(len(texts)):
        for j in range(i):
            if spots.likeness(sets[i], sets[j]) >= 0.7:
                assert member[i] == member[j]
    assert all(r["likeness"] >= 0.7 for r in linked.collect()) and len(member) == len(texts)


# 9


def test_tokens_equal_the_library(spark, odd, empty):
    import sentencepiece

    path = queries.tokenizer_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = tokens.model_at(path)
    rng = random.Random(4)
    alphabet = [*"ab  ▁<>/0x\n\té漢😀.=-", "<s>", "</s>", "<0x41>", "the", " ing"]
    cases = ["", " ", "a" * 3000, "ab" * 500, " " * 700, *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400))]
    for case in cases:
        ids = library.encode(case, add_eos=True)
        assert model.encode(case) == ids and model.decode(np.array(ids)) == library.decode(ids)
    for _ in range(200):
        ids = [rng.randrange(300) if rng.random() < 0.5 else rng.randrange(32000) for _ in range(rng.randint(0, 9))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)
    for r in tokens.tokenise(odd, path).collect():
        if r["doc_id"] is not None:
            ids = library.encode(ODD[r["doc_id"]] or "", add_eos=True)
            assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded_sha256"] == sha256(library.decode(ids).encode()).hexdigest()
    assert tokens.tokenise(empty, path).count() == 0


# 10


def test_chat_round_trip(spark):
    nasty = r"\### user: </turn> <next> \b\h : ###"
    talk = [(1, 2, "assistant", nasty), (1, 0, "user", "hi"), (1, 1, "user", nasty), (1, 3, "assistant", None), (1, 3, "assistant", None), (2, 0, "sys: <#\\", "x\ny"), (None, 0, None, "")]
    made = chat.format_conversations(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.trained_text(F.col("formatted"), F.col("spans")).alias("l"), "formatted").collect()}
    assert [tuple(t) for t in got[1]["t"]] == [("user", "hi"), ("user", nasty), ("assistant", nasty), ("assistant", ""), ("assistant", "")]
    assert got[1]["l"] == nasty and [tuple(t) for t in got[2]["t"]] == [("sys: <#\\", "x\ny")] and [tuple(t) for t in got[None]["t"]] == [("", "")]
    assert got[1]["formatted"].count("### ") == 2


def test_chat_of_an_empty_table_and_the_extra_conversation(spark, tmp_path):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).count() == 0
    spark.createDataFrame([(-7, 0, "user", "mine"), (1, 0, "assistant", "é#"), (1, 1, "assistant", "<next>"), (1, 2, "user", None)], none.schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((r["conv_id"], r["n_turns"], r["loss_chars"]) for r in queries.op10_chat(spark, str(tmp_path)).collect())
    assert got == [(-7, 1, 0), (-7, 2, 26), (1, 3, 8)]


def test_hosts_take_no_half_labels_and_one_reputation_a_host(spark, tmp_path):
    urls = [(i, "http://bad.net:8080/x" if i % 2 else "http://u@bad.net/y") for i in range(40)] + [(100 + i, "http://half.net/z") for i in range(20)] * 2 + [(300 + i, "http://fine.net/") for i in range(60)]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, 0, 1) for i in range(20)] + [(100 + i, None, 1) for i in range(20)] + [(300 + i, 1, 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op5_hosts(spark, str(tmp_path)).collect()
    assert {(r["host"], r["verdict"]) for r in got} == {("bad.net:8080", "block"), ("u@bad.net", "block"), ("half.net", "allow"), ("fine.net", "allow")} and len(got) == 140
    import duckdb

    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.execute(queries.oracle_sql()["op5_hosts"]).fetchall()
    assert sorted((r["page_id"], r["verdict"]) for r in got) == sorted((r[0], r[4]) for r in want)


def test_training_takes_one_text_of_a_repeated_id(spark):
    from mergewell.llm.common import training_rows

    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, None)], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id long, y int")
    first = training_rows(docs, lab, "y", 10)
    assert first == training_rows(docs.repartition(5), lab, "y", 10) and len(first[0]) == len({t for t, _ in first[0]}) <= 2


def test_rows_that_repeat_are_spread(spark, monkeypatch):
    monkeypatch.setattr(spots, "HOT_ROWS", 10)
    monkeypatch.setattr(spots, "REPEATED", 7)
    rows_ = [(1, "a b the c d e " * 5)] * 50 + [(None, None)] * 30 + [(i, f"of the cat {i} dog") for i in range(2, 20)] + [(5, "other")] * 12
    docs = spark.createDataFrame(rows_, "doc_id long, text string").repartition(5)
    ordered = sorted(rows_, key=lambda r: (r[0] is not None, r[0] or 0, sha256((r[1] or "").encode()).digest()[:16]), reverse=True)
    want = []
    for i, (doc_id, own) in enumerate(ordered):
        own, after = own or "", ordered[(i + 1) % len(ordered)][1] or ""
        third = len(own) // 3
        want.append((doc_id, sha256((own[: len(own) - third] + after[:third]).encode()).hexdigest()))
    for ranges in (1, 40, 2000):
        got = [(r["doc_id"], r["edited_sha256"]) for r in spots.edited_fingerprints(docs, ranges).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert spots.edited_fingerprints(docs.withColumn("doc_id", F.concat(F.lit("x"), "doc_id")), 4).count() == len(rows_)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_joins_of_large_tables_keep_hot_and_null_keys(spark, how, monkeypatch):
    from mergewell.llm import common

    wide = spark.createDataFrame([("a", i) for i in range(40)] + [("b", i) for i in range(3)] + [("c", 0), (None, 1), (None, 2)], "k string, rows int")
    found = spark.createDataFrame([("a", 1), ("b", 2), ("d", 3)], "k string, v int")
    want = sorted(wide.join(found, "k", how).collect(), key=str)
    assert sorted(common.join_small(wide, found, "k", how).collect(), key=str) == want
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    assert sorted(common.join_small(wide, found, "k", how).collect(), key=str) == want
