"""Collocations, Merkle manifest and Jaccard join against brute force; repeats in near dedup and the token cache."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard_join, merkle, near_dedup, phrases, ranking, token_counts
from ledgerlake.llm.automata import Counts
from tests.llm.test_group_operators import brute_components, near_copies
from tests.oracle_compare import compare, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_merkle_manifest"])
def test_queries_equal_their_sql(spark, name):
    from ledgerlake.llm import queries

    found = compare(queries.queries()[name](spark, SF), duck_connection(SF), queries.oracle_sql()[name])
    assert found["values_match"] and not found["type_diffs"], found


def test_positions(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab" if i % 3 else "c"), rng.randint(0, 40)) for i in range(500)]
    made = ranking.ranked(spark.createDataFrame(rows, "g string, x long").repartition(7), "g", ["x"], "t")
    out = defaultdict(list)
    for r in made.collect():
        out[r["g"]].append((r["pos"], r["x"], r["total"]))
    assert {g: sorted(v) for g, v in out.items()} == {
        g: [(i, x, n) for i, x in enumerate(sorted(y for h, y in rows if h == g))]
        for g, n in Counter(g for g, _ in rows).items()}


# ---- op11 ----

def brute_phrases(rows, s):
    """lang -> [(phrase, a, l, r, n, score)] by counting everything."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else s.other_lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, s.words + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = {}
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= s.least}
        inside = {}
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside.get(p[i:i + m], 0), a)
        rows_ = []
        for p, a in cand.items():
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside.get(p, 0) < s.inside_percent * a:
                rows_.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        if rows_:
            out[lang] = rows_[:s.top]
    return out


def test_phrases(spark):
    rng = random.Random(4)
    words = ["The", "the", "of", "é", "x|y", "\x00", "\xa0", "a", "New", "york", "city", "İ"]
    rows = []
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", ";"])
                       for _ in range(rng.randint(0, 60)))
        rows.append((text + rng.choice(["", "new york city hall", "x x x x x"]), rng.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), ("new york " * 3000, "en"), (None, None)] + [rows[0]] * 40
    s = phrases.Settings(least=20, top=40, held_words=700, range_bytes=900, filter_bits=1 << 12)
    docs = spark.createDataFrame([(t, g, i) for i, (t, g) in enumerate(rows)], "text string, lang string, words long")
    out = defaultdict(list)
    for r in phrases.phrases(docs, s).orderBy("lang", "rank").collect():
        assert r["rank"] == len(out[r["lang"]]) + 1
        out[r["lang"]].append((r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
    assert dict(out) == brute_phrases(rows, s)
    assert phrases.phrases(docs.limit(0), s).count() == 0
    assert phrases.phrases(docs.where("text is null"), s).count() == 0


def test_automata_union_and_composition():
    import numpy as np

    rng, total, parts = np.random.default_rng(7), Counter(), []
    for _ in range(4):
        vocabulary = sorted({bytes([97 + c]) for c in rng.integers(0, 9, 6)})
        ids = rng.integers(-1, len(vocabulary), 400)
        parts.append(Counts.from_sorted(vocabulary, ids, 3))
        for m in (1, 2, 3):
            runs = [ids[i:i + m] for i in range(len(ids) - m + 1)]
            total.update(tuple(vocabulary[j] for j in r) for r in runs if (r >= 0).all())
    united = Counts.from_bytes(Counts.union(parts).to_bytes())
    for k in range(3):
        assert {tuple(p): int(w) for p, w in zip(united.phrases(k), united.levels[k][2])} == {
            p: a for p, a in total.items() if len(p) == k + 1}
    asked = [[b"a"], [b"b", b"c"], [b"zz"], [b"a", b"zz"], *[list(p) for p in list(total)[:200]]]
    acceptor, where = Counts.of_phrases(asked)
    weights = united.compose(acceptor)
    assert [int(weights[k][arc]) for k, arc in where] == [total[tuple(p)] for p in asked]


def test_scores_beyond_64_bits(spark):
    """The arithmetic of scores with counts whose products pass 64 bits."""
    row = spark.range(1).select(F.expr(
        "cast(2000000 as decimal(20,0)) * cast(9000000000000000000 as decimal(20,0)) div "
        "(cast(9000000000000000000 as decimal(20,0)) + cast(9100000000000000000 as decimal(20,0)))").alias("s")).first()
    assert row["s"] == 2000000 * 9 * 10 ** 18 // (181 * 10 ** 17)


# ---- op12 ----

def brute_manifest(rows, fanout=16):
    """Per row (doc_id, leaf, subroot, root, proof, folded, verified), by building the whole tree."""
    def h(x):
        return hashlib.sha256(x.encode("utf-8")).hexdigest()

    def leaf(r, text):
        vals = [r[0], r[3], r[2], r[4], text]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))

    def climb(nodes):
        """root and, for each node, its [(left, right)] runs."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for i, p in enumerate(paths):
                lo = at[i] - at[i] % fanout
                run = level[lo:lo + fanout]
                p.append(("".join(run[:at[i] - lo]), "".join(run[at[i] - lo + 1:])))
            level = [h("".join(level[i:i + fanout])) for i in range(0, len(level), fanout)]
            at = [x // fanout for x in at]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[(r[3] is not None, (r[3] or "").encode())].append(r)
    subs = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        subs[g] = climb([leaf(r, r[1]) for r in members])
    order = sorted(subs)
    root, tops = climb([subs[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for r, path in zip(groups[g], subs[g][1]):
            path, end = path + top, root
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            if tampered:
                low = None if r[1] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
                end = leaf(r, low)
                for left, right in path:
                    end = h(left + end + right)
            out.append((r[0], leaf(r, r[1]), subs[g][0], root, h("".join(a + b for a, b in path)), end, end == root))
    return out


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest(docs_of, levels):
    rng = random.Random(levels)
    rows = [(i, rng.choice([None, "", "Aé\U0001f600 b", "lower only", f"T{i}"]), rng.choice(["en", None]),
             "hot" if i % 3 else rng.choice([None, "", "é", "Z", "z", f"s{i % 40}"])) for i in range(700)]
    rows += [(None, "null id", "en", "hot"), (5, "again", "en", "hot"), (5, "again", "en", "hot"), (900, "Long " * 40000, "en", "one")]
    docs = docs_of(rows, extra="pos grp digest total path root")
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    out = merkle.op12_merkle_manifest(docs, merkle.Settings(levels=levels))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r[c] for c in names) for r in out.collect()) == Counter(brute_manifest(full))
    assert merkle.op12_merkle_manifest(docs.limit(0)).count() == 0
    single = docs.where("doc_id = 900")
    assert [(r["leaf"] == r["subroot"] == r["root"], r["path"]) for r in merkle.manifest(single).collect()] == [(True, [])]


def test_untampered_roots_are_folded(docs_of, monkeypatch):
    """A wrong sibling shows in every row, also where the text was left alone."""
    docs = docs_of([(i, f"t{i}", "en", "a") for i in range(40)])
    kept = merkle.manifest

    def forged(*args, **carried):
        wrong = F.transform("path", lambda run: F.struct(F.concat(run["left"], F.lit("0")).alias("left"), run["right"]))
        return kept(*args, **carried).withColumn("path", wrong)

    assert {r["verified"] for r in merkle.op12_merkle_manifest(docs).where("doc_id in (1, 2, 3)").collect()} == {True}
    monkeypatch.setattr(merkle, "manifest", forged)
    assert {r["verified"] for r in merkle.op12_merkle_manifest(docs).collect()} == {False}


# ---- op13 ----

@pytest.mark.parametrize("page, spare", [(64, 20), (4, 20), (4, 1000)])
def test_jaccard_join(docs_of, page, spare):
    rng = random.Random(page)
    texts = [None, "", " \n", "a", "A", "a b", "b a", "a b c d e f", "a\tb\x0bC d e f", "x " * 30000, "x " * 200]
    texts += near_copies(rng, 6, 14, [f"W{i}" for i in range(300)])
    texts += texts[-3:] * 5
    data = list(enumerate(texts)) + [(None, texts[-1]), (None, None), (20, texts[20]), (20, texts[20])]
    docs = docs_of(data, extra="node n grp tree idx")
    s = jaccard_join.Settings(words=4, percent=85, page=page, fan=3, spare=spare, groups=1 << 8)
    out = jaccard_join.linked(docs, s).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in out) == brute_components(data, 4, 85)
    assert jaccard_join.linked(docs.limit(0), s).count() == 0


def test_jaccard_join_shuffles_no_texts_and_entries_once(docs_of, monkeypatch):
    """With more classes than are broadcast: the plans of what is written, and the same links."""
    rng = random.Random(8)
    texts = near_copies(rng, 3, 8, [f"W{i}" for i in range(300)]) + ["a b c d e", None, ""]
    data = list(enumerate(texts + texts[-5:])) + [(3, texts[3]), (4, texts[5]), (None, texts[3])]
    plans, write = defaultdict(list), jaccard_join.materialize

    def recorded(df, name):
        plans[name].append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(jaccard_join, "materialize", recorded)
    monkeypatch.setattr(jaccard_join, "broadcast_row_limit", lambda df: 3, raising=False)
    monkeypatch.setattr(jaccard_join, "_small", lambda df: df)
    monkeypatch.setattr(near_dedup, "broadcast_row_limit", lambda df: 3)
    s = jaccard_join.Settings(words=4, percent=85, page=4, fan=3, groups=1 << 8, broadcast_pairs=3)
    docs = docs_of(data)
    docs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard_join.linked(docs, s).collect()
    finally:
        docs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in out) == brute_components(data, 4, 85)
    below = plans["listed"][0].partition("MapInArrow")[2].partition("Scan")[0]  # from the texts' scan up to their listing
    assert below and "Exchange" not in below
    by_group = [p for texts in plans.values() for p in texts if re.search(r"Exchange hashpartitioning\(grp", p)]
    assert len(by_group) == 2  # the entries, and the members of leaf groups


# ---- repeats ----

def test_keep_one_decides_by_text(docs_of):
    """A text is not lost because its id repeats, and each group keeps one document."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = docs_of([(1, a), (2, a), (2, b), (3, b + " more"), (4, None), (4, None), (None, a), (5, ""), (5, "c")])
    kept = Counter((r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect())
    assert kept == Counter([(1, a), (2, b), (4, None), (5, ""), (5, "c"), (None, a)])


def test_two_writers_of_the_cache(spark, docs_of, word_bpe, tmp_path):
    """A content that two runs stored counts once."""
    docs = docs_of([(1, "some words"), (2, "other words here"), (3, "some words")])
    cache = str(tmp_path / "cache")
    first = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, word_bpe, cache).collect()}
    rows = spark.read.schema(token_counts.CACHE_SCHEMA).parquet(cache).collect()
    spark.createDataFrame(rows, token_counts.CACHE_SCHEMA).write.mode("append").parquet(cache)
    again = token_counts.count_tokens(docs, word_bpe, cache).collect()
    assert len(again) == 3 and {r["doc_id"]: r["n_tokens"] for r in again} == first


# ---- op4: what crossover adds ----

def test_islands_with_crossover_need_fewer_sequences(spark):
    """Lengths that best fit can't pack well: islands with crossover need strictly fewer sequences."""
    from ledgerlake.llm import packing
    from ledgerlake.llm.common import materialize

    rng = random.Random(4)
    lengths = [rng.randint(300, 1100) for _ in range(600)]
    pieces = materialize(spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long"), "test-pieces")

    def packed(**given):
        out = packing.pack_pieces(pieces, packing.Settings(island_pieces=300, **given)).collect()
        assert sorted(r["length"] for r in out) == sorted(lengths)
        filled = Counter()
        for r in out:
            filled[r["sequence_id"]] += r["length"]
        assert max(filled.values()) <= 2048
        return len(filled)

    assert packed(generations=120) < packed(generations=0, population=1)
