"""The operators without SQL and the whole pipeline, replayed in plain Python on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from mergewell.llm import decontaminate, line_templates, near_dup, quality, queries, spots, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# 1 and 3: held-out accuracy, and the score of each text by a model fitted apart from Spark


def plain_sample(spark, docs, label, per_class):
    seen = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        if r["doc_id"] is not None and r[label] is not None and not held_out(r["doc_id"]):
            seen[r["doc_id"]].append(r[label])
    known = {i: np.mean(v) >= 0.5 for i, v in seen.items()}
    assert max(Counter(known.values()).values()) <= per_class
    return [(docs[i].encode(), bool(known[i])) for i in sorted(known) if docs.get(i) is not None], {y: n for y, n in Counter(map(bool, known.values())).items()}


@pytest.mark.parametrize("name,label,made", [("op1_quality", "quality", quality.QualityModel), ("op3_toxicity", "toxic", toxicity.ToxicityModel)])
def test_scores_equal_a_model_fitted_apart(spark, docs, name, label, made):
    module = quality if name == "op1_quality" else toxicity
    model = made(*plain_sample(spark, docs, label, module.PER_CLASS))
    got = {r["doc_id"]: r for r in queries.queries()[name](spark, SF).collect()}
    want = dict(zip(docs, model.score([(t or "").encode() for t in docs.values()])))
    assert set(got) == set(docs) and all(abs(got[i]["score"] - want[i]) < 1e-9 and got[i]["held_out"] == held_out(i) for i in docs)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op1_quality(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert len(scored) > 50 and np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95


# 6


def plain_fingerprint(text, width=3):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return "0" * 16
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)):016x}"


def test_simhash_equals_plain_python(spark, docs):
    got = {r["doc_id"]: r for r in queries.op6_simhash(spark, SF).collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == prints
    component = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for i in docs:
            for j in docs:
                if (int(prints[i], 16) ^ int(prints[j], 16)).bit_count() <= 3 and component[i] > component[j]:
                    component[i], changed = component[j], True
    assert {i: r["component_id"] for i, r in got.items()} == component


# 7


def plain_mask(line):
    clean = re.sub(r"[\t\x0b\f\r ]+", " ", line).strip(" ")
    return re.sub(r"[^ ]*[0-9][^ ]*", "<*>", clean)


def plain_line_dedup(texts):
    """{id: text} after the removal: leaves of token count and first tokens, templates by line_templates.gathered (tested apart), first text keeps its lines."""
    where, first = defaultdict(set), {}
    key = lambda i: (i, hashlib.sha256(texts[i].encode()).digest()[:16])
    for i, t in texts.items():
        if t is not None:
            for line in map(plain_mask, t.split("\n")):
                if line.count(" ") + 1 >= line_templates.MIN_TOKENS or len(line) >= line_templates.MIN_CHARS:
                    where[line].add(t)
                    first[line] = min(first.get(line, key(i)), key(i))
    leaves = defaultdict(list)
    for line in where:
        words = line.split(" ")
        leaves[len(words), " ".join(words[: line_templates.DEPTH])].append(line)
    template = {line: line for line in where}
    for (n, _), lines in leaves.items():
        least = line_templates.MIN_DOCS_LONG if n > line_templates.LONG else line_templates.MIN_DOCS
        if n >= 5 and len(lines) > 1 and sum(len(where[x]) for x in lines) >= least:
            lines.sort(key=lambda x: (-len(where[x]), xxhash.xxh64_intdigest(x.encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest(x.encode(), 42) >> 63)))
            numbers = {}
            forms = np.array([[numbers.setdefault(w, len(numbers)) for w in x.split(" ")] for x in lines])
            for x, o in zip(lines, line_templates.gathered(forms)):
                template[x] = lines[o]
    members = defaultdict(list)
    for line, t in template.items():
        members[t].append(line)
    gone = {}
    for lines in members.values():
        n = lines[0].count(" ") + 1
        if len(set().union(*(where[x] for x in lines))) >= (line_templates.MIN_DOCS_LONG if n > line_templates.LONG else line_templates.MIN_DOCS):
            owner = min(first[x] for x in lines)
            gone |= {x: texts[owner[0]] for x in lines}
    return {i: t if t is None or not any((m := plain_mask(x)) in gone and gone[m] != t for x in t.split("\n")) else "\n".join(x for x in t.split("\n") if not ((m := plain_mask(x)) in gone and gone[m] != t)) for i, t in texts.items()}


def test_line_dedup_equals_plain_python(spark, docs):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(frame)[0].collect()}
    want = plain_line_dedup(docs)
    assert sum(got[i] != docs[i] for i in docs) > 5
    # commonest tokens of a template break ties by their hashes, so a line of a leaf may differ where the plain numbers order otherwise
    assert sum(got[i] != want[i] for i in docs) <= 1


def test_large_leaves_give_the_same_lines(spark, monkeypatch):
    lines = [[f"alpha beta gamma t{chr(97 + t)}x u{chr(97 + t)}x mid{chr(97 + v)} w{chr(97 + t)}x v{chr(97 + t)}x y z" for v in range(8)] for t in range(4)]
    rows = [(v, "\n".join(x[v] for x in lines)) for v in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(frame)[0].collect()}
    monkeypatch.setattr(line_templates, "LEAF_FORMS", 10)
    assert {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(frame)[0].collect()} == whole == {0: rows[0][1]} | {v: "" for v in range(1, 8)}


# 8


def test_spot_signatures_equal_a_plain_version(docs):
    edges = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    for text in docs.values():
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = [w for w in (x.strip(edges) for x in re.split("[\x20\x09-\x0d]+", lowered)) if w]
        common = [w.encode() in spots.ANCHORS for w in words]
        found = set()
        for i, w in enumerate(words):
            chain = [words[j] for j in range(i + 1, len(words)) if not common[j]][:2] if common[i] else []
            if len(chain) == 2:
                found.add(" ".join([w, *chain]))
        hashes = {xxhash.xxh32_intdigest(x.encode()) for x in found} or {xxhash.xxh32_intdigest(("\0" + " ".join(words)).encode())}
        assert spots.signatures((text or "").encode()) == sorted(hashes)


# 4 and the pipeline


@lru_cache(maxsize=None)
def plain_template(text, kind):
    inside = r"\p{L}\p{M}\p{N}"
    body = (text or "").translate(str.maketrans("\x01\x02\x03", "   "))
    body = body.lower() if kind else body
    runs, form = [], []
    for m in regex.finditer(rf"([0-9]+)|([{inside}]+)", body):
        word = m[0]
        glued = m.start() > 0 and regex.match(f"[{inside}]", body[m.start() - 1])
        mark = "n" if m[1] else "N" if regex.match(r"\p{Lu}", word) and not glued else "u" if form and form[-1] == "n" and word.lower() in decontaminate.UNITS else None
        if mark in ("n", "N") and form and form[-1] == mark:
            runs[-1].append(word)
        else:
            form.append(mark or word.lower())
            runs.append([word])
    return form, runs


def plain_windows(form):
    return [(p, tuple(form[p : p + 5])) for p in range(len(form) - 4)]


@lru_cache(maxsize=None)
def plain_places(text, kind):
    places = defaultdict(list)
    for q, w in plain_windows(plain_template(text, kind)[0]):
        places[w].append(q)
    return places


def plain_matches(doc, item):
    """Whether a text holds an item, by all alignments of all windows."""
    any_window = False
    for kind in (0, 1):
        form, runs = plain_template(item, kind)
        mine = {p: w for p, w in plain_windows(form) if sum(t not in "nNu" or len(t) > 1 for t in w) >= decontaminate.MIN_LITERALS}
        any_window |= bool(mine)
        own_form, own_runs = plain_template(doc, kind)
        places = plain_places(doc, kind)
        shifts = {p: {q - p for q in places.get(w, ())} for p, w in mine.items()}
        strength = Counter(s for x in shifts.values() for s in x)
        for base, drift in {(s, 0) for s in strength} | {(s - d, decontaminate.DRIFT) for s in strength for d in range(decontaminate.DRIFT + 1)}:
            path = {p: max((s for s in x if base <= s <= base + drift), key=lambda s: (strength[s], s), default=None) for p, x in shifts.items()}
            path = {p: s for p, s in path.items() if s is not None}
            if not mine or len(path) < len(mine) * decontaminate.OVERLAP:
                continue
            pairs = set()
            for i, mark in enumerate(form):
                if mark not in ("n", "N", "u"):
                    continue
                covering = [s for p, s in sorted(path.items()) if p <= i < p + 5]
                if covering:
                    at = i + covering[0]
                elif not any(p <= i < p + 5 for p in mine):
                    behind = [s for p, s in sorted(path.items()) if p <= i] or [min(path.items())[1]]
                    at = i + behind[-1]
                    if not (0 <= at < len(own_form) and own_form[at] == mark):
                        continue
                else:
                    continue
                a, b = runs[i], own_runs[at]
                pairs |= set(zip(a, b)) if len(a) == len(b) else {(" ".join(a), " ".join(b))}
            if len({a for a, _ in pairs}) == len(pairs):
                return True
    whole = lambda t: " ".join(regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower()))
    return not any_window and whole(item) != "" and whole(doc) == whole(item)


def test_decontamination_equals_plain_python(spark, docs):
    items = {r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id is not null").collect()}
    got = {r["doc_id"]: r["contaminated"] for r in queries.op4_decontamination(spark, SF).collect()}
    assert got == {i: t is not None and any(plain_matches(t, x) for x in items) for i, t in docs.items()}


def plain_near_dedup(texts):
    sets = {}
    for i, t in texts.items():
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[i] = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    group = {i: i for i in texts}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                group[b] = a
    return {i: t for i, t in texts.items() if find(i) == i}


def test_pipeline_equals_a_plain_replay(spark, docs):
    import sentencepiece

    model = toxicity.ToxicityModel(*plain_sample(spark, docs, "toxic", toxicity.PER_CLASS))
    kept = {i: t for (i, t), s in zip(docs.items(), model.score([(t or "").encode() for t in docs.values()])) if s < 0.5}
    frame = spark.createDataFrame(sorted(kept.items()), "doc_id long, text string")
    cleaned = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(frame)[0].collect()}  # held against plain Python above
    items = {r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id is not null").collect()}
    left = {i: t for i, t in plain_near_dedup(cleaned).items() if t is None or not any(plain_matches(t, x) for x in items)}
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(left) and 100 < len(out) < len(docs)
    for i, t in left.items():
        ids = library.encode(t or "", add_eos=True)
        assert list(out[i]["ids"]) == ids and out[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# names that clash with those an operator needs itself


def test_columns_of_any_name_pass_through(spark):
    from mergewell.llm import stages

    names = ["text_id", "drops", "score", "th", "found", "chosen", "row", "has_id", "salt", "__th", "__drops", "__id", "__score", "TEXT_ID_", "w", "x", "k", "item"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    line = "one two three four five six seven eight nine ten"
    rows = [(i, f"{line}\nown words {'abcdefg'[i] * 5} here {'gfedcba'[i] * 4} there {'xyzuvwr'[i] * 6}", *[f"mine {n} {i}" for n in names]) for i in range(7)]
    frame = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
    outs = [stages.drop_toxic(frame, labels), line_templates.drop_recurring_lines(frame)[0], near_dup.keep_first(frame, 5), decontaminate.drop_contaminated(frame, bench)]
    for out in outs:
        assert out.columns == frame.columns
        for r in out.collect():
            assert [r[n] for n in names] == [f"mine {n} {r['doc_id']}" for n in names]
    assert [o.count() for o in outs] == [7, 7, 7, 6]
