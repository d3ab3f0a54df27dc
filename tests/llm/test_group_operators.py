"""Near dedup, packing, mixing, neighbours, toxicity and the pipeline against brute force on small fixtures."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import ann, graph, mixing, near_dedup, packing, toxicity
from tests.oracle_compare import compare, duck_connection

SF = "/root/testdata/sf0.001"


# ---- op2 ----

def brute_components(data, words, percent=80):
    """(id, set size, smallest id reachable) of each row, by comparing all pairs."""
    sets = []
    for _, t in data:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    label = [i for i, _ in data]
    changed = True
    while changed:
        changed = False
        for a, x in enumerate(sets):
            for b in range(a):
                y = sets[b]
                if data[a][0] is None or data[b][0] is None or not x or not y or label[a] == label[b]:
                    continue
                if 100 * len(x & y) >= percent * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return sorted((str(i), len(s), label[k]) for k, ((i, _), s) in enumerate(zip(data, sets)))


def near_copies(rng, n, group, vocabulary):
    """Groups of edited copies, from light to heavy edits, and texts that share a passage."""
    texts, passage = [], " ".join(rng.choice(vocabulary) for _ in range(60))
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        for _ in range(group):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            texts.append(" ".join(copy))
        texts.append(passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 80))))
    return texts


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(docs_of, words):
    rng = random.Random(words)
    vocabulary = [f"W{i}" for i in range(500)]
    texts = [None, "", " \n", "a", "A", "a b", "b a", "a b c d e f", "a\tb\x0bC d e f", "x " * 30000, "x " * 200]
    texts += near_copies(rng, 6, 12, vocabulary)
    texts += texts[-3:] * 5
    data = list(enumerate(texts)) + [(None, texts[-1]), (None, None)]
    docs = docs_of(data, extra="node n key component_id")
    out = near_dedup.near_duplicates(docs, near_dedup.Settings(words=words)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in out) == brute_components(data, words)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    if words == 5:
        kept = near_dedup.keep_one(docs.unionByName(docs))
        assert kept.columns == docs.columns
        assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
            [r["doc_id"] for r in out if r["kept"] and r["doc_id"] is not None] + [None] * 4)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_large_buckets_take_the_sharper_bound(docs_of):
    """Small limits send the group through hubs, rare shingles and several rounds."""
    rng = random.Random(9)
    texts = near_copies(rng, 2, 60, [f"w{i}" for i in range(40)])
    data = list(enumerate(texts))
    out = near_dedup.near_duplicates(docs_of(data), near_dedup.Settings(words=4, hubs=(2, 3), rare=3)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in out) == brute_components(data, 4)


def test_repeated_rows_count_once_in_the_bounds(spark, docs_of):
    """Rows that repeat an id add nothing to the counts of shingles that rule pairs out in large buckets."""
    rng, s = random.Random(9), near_dedup.Settings(words=4, rare=8)
    texts = []
    for i in range(12):  # a template whose every variant has words of its own
        words = [f"c{k}" for k in range(100)]
        for k in range(1 + i % 3):
            words[rng.randrange(100)] = f"own{i}x{k}"
        texts.append(" ".join(words))
    sets = [set(near_dedup.shingle_set(t, 4).tolist()) for t in texts]
    held = Counter(x for found in sets for x in found)
    docs = docs_of([(i, t) for i, t in enumerate(texts) for _ in range(2)]).select("doc_id", "text")
    classes = near_dedup._classes(docs.mapInArrow(
        near_dedup._signature_batches(s), "doc_id long, n long, digest binary, hashes array<long>"))
    other = docs.unionByName(docs_of([(0, "another text under a repeated id")]).select("doc_id", "text"))
    made = near_dedup._sets(other, classes, s)
    assert sorted(r["node"] for r in made.collect()) == list(range(12))
    entries = spark.createDataFrame([(1, i, len(x), len(x), i) for i, x in enumerate(sets)],
                                    "key long, node long, n long, t long, component long")
    _, uncommon = near_dedup._rare_pairs(entries, made, s)
    assert {r["node"]: r["uncommon"] for r in uncommon.collect()} == {
        i: sum(held[k] < s.rare for k in x) for i, x in enumerate(sets)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    out = graph.components(spark.createDataFrame(edges, "u long, v long"))
    assert dict((r["node"], r["component"]) for r in out.collect()) == label


# ---- op4 ----

def test_packing(docs_of, byte_bpe):
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(byte_bpe), random.Random(6)
    texts = [None, "", "word " * 9000, "<|endoftext|> special", "é中\U0001f600 " * 50]
    texts += [" ".join(rng.choice("alpha beta gamma".split()) for _ in range(rng.randint(1, 300))) for _ in range(300)]
    data = list(enumerate(texts)) + [(None, "null id"), (3, texts[3])]
    docs = docs_of(data, extra="piece length bin island")
    settings = packing.Settings(capacity=256, island_pieces=100, generations=4)
    packed = packing.pack(docs, byte_bpe, 0, settings, keep_ids=True).collect()
    pieces = {}
    for r in packed:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] <= 256 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        pieces.setdefault(str(r["doc_id"]), []).append((r["piece"], r["start"], ids))
    for i, t in data:
        whole = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        times = sum(x == (i, t) for x in data)
        mine = sorted(pieces[str(i)])
        for k in range(times):
            own = mine[k::times]
            assert [p for p, _, _ in own] == list(range(len(own)))
            assert [x for _, _, ids in own for x in ids] == whole
            assert all(len(ids) == 256 for _, _, ids in own[1:])
            assert [s for _, s, _ in own] == [sum(len(x[2]) for x in own[:j]) for j in range(len(own))]
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in packed)
    islands = -(-sum(r["length"] < 256 for r in packed) // 100)
    assert len(bins) <= -(-total // 256) + 2 * islands
    assert packing.pack(docs.limit(0), byte_bpe).count() == 0


def test_evolution_beats_best_fit():
    """Triplets that fill bins exactly: best fit alone wastes some, the algorithm finds fuller bins and keeps all items."""
    rng = random.Random(7)
    lengths = []
    for _ in range(60):
        a = rng.randint(500, 900)
        b = rng.randint(500, 2048 - a - 250)
        lengths += [a, b, 2048 - a - b]
    s = packing.Settings(generations=60, population=8)
    plain = packing.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 2048, packing.Packing([], []))
    found = packing.evolve(lengths, None, [], s, 1)
    assert sorted(i for b in found for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in found) and len(found) <= len(plain.bins)
    patterns = [sorted(lengths[3 * i:3 * i + 3], reverse=True) for i in range(60)]
    assert len(packing.evolve(lengths, None, patterns, s, 1)) == 60  # migrants that hold the answer are used


def test_sequences(docs_of, byte_bpe):
    packed = packing.pack(docs_of([(i, f"text number {i}") for i in range(20)]), byte_bpe, 0, keep_ids=True)
    out = packing.sequences(packed).collect()
    assert sum(r["length"] for r in out) == packed.agg(F.sum("length")).first()[0]
    assert all(len(r["ids"]) == 4 * r["length"] for r in out)


# ---- op5 ----

def test_mixing(spark, docs_of):
    rng = random.Random(8)
    data = [(i, "w " * rng.randint(1, 40), "en", "big" if i % 3 else f"s{i % 5}") for i in range(400)]
    data += [(1000, None, "en", "big"), (1001, "", "en", None), (1002, "a b c", "en", None), (None, "x y", "en", "s0")]
    data += [(7, "same id", "en", "s1")] * 2
    docs = docs_of(data, extra="weight copies block")
    for s in (mixing.Settings(), mixing.Settings(repeats=1.5), mixing.Settings(entropy=None, repeats=2.0),
              mixing.Settings(entropy=0.9, budget=3000), mixing.Settings(blocks=1)):
        out = mixing.mixed(docs, s).collect()
        assert len(out) == len(data)
        total, used, weight, n = Counter(), Counter(), {}, Counter()
        for r in out:
            m = r["_mx"]
            total[r["source"]] += m["n_tokens"]
            used[r["source"]] += m["n_tokens"] * m["copies"]
            weight[r["source"]] = m["weight"]
            n[r["source"]] += 1
        assert abs(sum(weight.values()) - 1) < 1e-9
        budget = s.budget or max(total[x] / weight[x] for x in total if total[x])
        for x in total:  # a source misses its tokens by less than a longest row
            assert 0 <= weight[x] * budget - used[x] + 1 <= 42, (x, weight[x] * budget, used[x])
        if s.budget is None:
            assert all(r["_mx"]["copies"] >= 1 for r in out)
        if s.repeats and not s.budget:
            assert max(used[x] / total[x] for x in total) <= s.repeats + 1e-6
        if s.entropy:
            entropy = -sum(w * np.log(w) for w in weight.values() if w)
            assert entropy <= s.entropy * np.log(len(weight)) + 1e-6
        for x in total:  # positions are a gapless order of the source
            places = sorted((r["_mx"]["position"], r["_mx"]["n_tokens"]) for r in out if r["source"] == x)
            assert all(p + t <= q for (p, t), (q, _) in zip(places, places[1:]))
    mixed = mixing.mix(docs, mixing.Settings(entropy=None, repeats=2.0))
    assert mixed.columns == docs.columns and mixed.count() >= len(data)
    assert mixing.mix(docs.limit(0)).count() == 0


# ---- op7 ----

def brute_nearest(vectors, k, every):
    ok = [(i, np.array(v, float)) for i, v in vectors if i is not None and v and None not in v
          and np.isfinite(np.array(v, float)).all() and any(v)]
    out = set()
    for i, q in ok:
        if i % every == 0:
            near = sorted((-float(x @ q), j) for j, x in ok if j != i and len(x) == len(q))[:k]
            out |= {(i, r + 1, j) for r, (_, j) in enumerate(near)}
    return out


def test_nearest_small_is_exact(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.integers(-9, 9, 6).astype(float).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[0][1]) for i in range(60)]  # copies
    vectors += [(400, None), (420, []), (440, [0.0] * 6), (460, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (480, [float("nan")] * 6),
                (500, [float("inf")] * 6), (None, [1.0] * 6), (520, [1.0, 2.0]), (521, [3.0, 1.0])]
    df = spark.createDataFrame([(i, v, i) for i, v in vectors], "vec_id long, embedding array<float>, score long")
    out = ann.op7_nearest(df, k=20, every=20).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in out} == brute_nearest(vectors, 20, 20)
    assert len(out) == len({(r["query_id"], r["rank"]) for r in out})
    assert ann.op7_nearest(df.limit(0)).count() == 0


def test_repeated_ids_show_their_largest_score(spark):
    """An id with several vectors is one candidate, by the best of them; a repeated query id is answered once."""
    rng = np.random.default_rng(5)
    vectors = [(int(i), rng.integers(-9, 9, 6).astype(float).tolist()) for i in rng.integers(0, 40, 240)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    right = {}
    for q, x in vectors:
        for v, y in vectors:
            if q % 20 == 0 and v != q:
                score = float(np.dot(x, y))
                right[q, v] = max(right.get((q, v), score), score)
    ranked = {q: sorted(((-s, v) for (p, v), s in right.items() if p == q))[:20] for q in {p for p, _ in right}}
    for s in (ann.Settings(), ann.Settings(shard_rows=40, query_block=2)):
        out = ann.search(ann.build_index(df, 60, s), df.where("vec_id % 20 = 0"), 60, s).where("rank <= 20").collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == sorted(
            (q, i + 1, v, -s) for q, near in ranked.items() for i, (s, v) in enumerate(near))


def test_recall_over_shards(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    s = ann.Settings(shard_rows=800, query_block=64)
    out = ann.search(ann.build_index(df, 20, s), df.where("vec_id % 20 = 0"), 20, s).collect()
    x = x.astype(np.float32).astype(float)
    right = {(q, int(j)) for q in range(0, 3000, 20)
             for j in [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20]}
    assert len(out) == 150 * 20 and len(right & {(r["query_id"], r["vec_id"]) for r in out}) >= 0.9 * len(right)


# ---- op8 ----

def test_toxicity_learns_words_and_pairs(spark, docs_of):
    rng = random.Random(10)
    filler = [f"word{i}" for i in range(300)]
    data, labels = [], []
    for i in range(1600):
        kind = rng.choice("insult pair-a pair-b pair-both clean clean".split())
        more = {"insult": ["idiot"], "pair-a": ["zealots"], "pair-b": ["group7"], "pair-both": ["zealots", "group7"]}
        words = [rng.choice(filler) for _ in range(rng.randint(5, 60))] + more.get(kind, [])
        rng.shuffle(words)
        data.append((i, " ".join(words)))
        labels.append((i, int(kind in ("insult", "pair-both"))))
    docs = docs_of(data + [(5000, None), (5001, ""), (None, "idiot"), (0, data[0][1])], extra="score toxic")
    truth = spark.createDataFrame(labels + [(None, 1), (9999, 1), (0, None), (3, labels[3][1])], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, truth)).collect()
    assert len(out) == len(data) + 4 and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in out)
    held = {i for i in range(1600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {r["doc_id"] for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1600} == held
    by_id = {r["doc_id"]: r["predicted"] for r in out}
    assert sum(by_id[i] == y for i, y in labels if i in held) / len(held) >= 0.95
    flat = toxicity.score(docs, toxicity.fit(docs, truth.limit(0)))
    assert flat.where("score != 0 or predicted != 0").count() == 0
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), truth)).count() == 0


def test_terms_are_counted_beyond_the_sample(spark, docs_of):
    """A word rare among the sampled rows is kept by its count over all labelled rows; held-out rows count nothing."""
    rng = random.Random(11)
    data = [(i, " ".join(rng.choice("red blue green grey".split()) for _ in range(20))
             + (" vermin" if i % 2 and i % 3 == 0 else "")) for i in range(1200)]
    truth = spark.createDataFrame([(i, i % 2) for i, _ in data], "doc_id long, toxic int")
    few = toxicity.Settings(max_rows_per_label=8)
    held = {i for i, _ in data if zlib.crc32(str(i).encode()) % 4 == 2}
    model = toxicity.fit(docs_of(data), truth, few)
    assert set(model.buckets.tolist()) == set(toxicity.Terms(few)("vermin").tolist())
    only_held = [(i, t if i in held else t.replace(" vermin", "")) for i, t in data]
    assert not len(toxicity.fit(docs_of(only_held), truth, few).buckets)


def test_machine_equals_the_explicit_sum(spark):
    rng = np.random.default_rng(12)
    machine = toxicity.FactorizationMachine(30, toxicity.Settings())
    machine.w, machine.v, machine.bias = rng.normal(size=30), rng.normal(size=machine.v.shape), 0.3
    rows = [np.sort(rng.choice(30, n, replace=False)) for n in (0, 1, 2, 7, 30)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    right = [0.3 + sum(machine.w[i] for i in r)
             + sum(machine.v[i] @ machine.v[j] for i in r for j in r if i < j) for r in rows]
    assert np.allclose(machine.margins(np.concatenate(rows).astype(int), starts), right)


# ---- registered queries and the pipeline ----

def test_queries_equal_their_sql(spark):
    from ledgerlake.llm import queries

    con, found = duck_connection(SF), queries.queries()
    assert len([n for n in found if n.startswith("op")]) == 13
    for name, sql in queries.oracle_sql().items():
        result = compare(found[name](spark, SF), con, sql)
        assert result["values_match"] and not result["type_diffs"], (name, result)


def test_pipeline(spark, docs_of, byte_bpe):
    """Each stage keeps what it must, and run() is the stages one after another."""
    from ledgerlake.llm.common import materialize, table

    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, before, SF), name)
        if name != "best_fit":
            assert docs.columns == columns
        old, new = ({r["doc_id"]: r for r in df.collect()} for df in (before, docs))
        assert set(new) <= set(old)
        if name in ("quality_rules", "near_dedup", "source_mixing"):
            assert all(new[i] == old[i] for i in new)
        if name in ("line_dedup", "source_mixing", "best_fit"):
            assert set(new) == set(old)
        if name == "near_dedup":
            data = sorted((i, r["text"]) for i, r in old.items())
            assert set(new) == {c for _, _, c in brute_components(data, 5)}
    whole = corpus_pipeline.run(spark, SF)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(whole.select(*key).collect()) == Counter(docs.select(*key).collect())
    empty = docs_of([(1, "x")]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    odd = docs_of([(None, None), (None, None), (1, None, None, None), (1, None, None, None), (2, "a b " * 40000)])
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).collect()
