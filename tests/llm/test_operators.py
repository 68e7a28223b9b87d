"""The training-data operators against brute force, and on the cases that data brings."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from scriptorium.llm import components, decontaminate, jaccard_join, langid, mixing, passages, quality, sharding, token_files, toxicity, url_filter
from scriptorium.llm.queries import tokenizer_path

FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30000))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5), (4, "one", "en", None, 3), (4, "one", "en", None, 3),
    (None, "no key at all", "en", "b", 3), (None, None, None, None, None), (5, LONG, "en", "a", len(LONG)), (6, "x " * 500, "en", "b", 1000), (7, "été 中文 😀 ok", "fr", "c", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def docs(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [(i, " ".join(f"v{r.randrange(vocabulary)}" for _ in range(r.randrange(0, 90))), "en", r.choice(["a", "b", "c", None]), 0) for i in range(n)]


# mixing


@pytest.mark.parametrize("block", [7, 128])
def test_mix_meets_targets_and_caps(spark, block):
    rows = docs(1, 300)
    out = mixing.taken(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block, shard_slots=16).toPandas()
    size = {k: len(words(t)) for k, t, *_ in rows}
    assert len(out) == len(rows) and all(size[r.doc_id] == r["size"] for _, r in out.iterrows())
    assert (out.taken <= 2 * out["size"]).all()
    source = {r[0]: r[3] for r in rows}
    out["source"] = [source[k] or "~" for k in out.doc_id]
    sums = {s: g["size"].sum() for s, g in out.groupby("source")}
    want, weights = {}, dict(zip(["a", "b", "c", "~"], [3, 1, 2, 3], strict=True))
    budget, open_ = 1.5 * sum(sums.values()), set(sums)
    while open_:  # stop at the cap, share again
        level = (budget - sum(want.values())) / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * sums[s]}
        if not over:
            want |= {s: level * weights[s] for s in open_}
            break
        want |= {s: 2.0 * sums[s] for s in over}
        open_ -= over
    for s, g in out.groupby("source"):
        assert g.target.iloc[0] == pytest.approx(want[s]) and abs(g.taken.sum() - want[s]) <= 1 and (g.source_size == sums[s]).all()


def test_mix_is_made_of_blocks_and_reruns_agree(spark):
    rows = docs(2, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = mixing.blocks(df, block=16, shard_slots=8).toPandas()
    assert [len(words(t)) for t in blocks.text] == blocks.words.tolist() and blocks.words.max() == 16
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in blocks.groupby("shard"))
    again = mixing.blocks(df.repartition(5), block=16, shard_slots=8).toPandas()
    key = ["shard", "slot"]
    assert blocks.sort_values(key).text.tolist() == again.sort_values(key).text.tolist()
    taken = {r.doc_id: r.taken for r in mixing.taken(df, block=16, shard_slots=8).collect()}
    mixed = Counter()
    out = mixing.documents(df, block=16, shard_slots=8)
    assert out.columns == df.columns
    text = {r[0]: r[1] for r in rows}
    for r in out.collect():
        mixed[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text) and not Counter(words(r.text)) - Counter(words(text[r.doc_id]))
    assert mixed == Counter({k: v for k, v in taken.items() if v})


def test_permutation_is_a_bijection(spark):
    sizes = (1, 2, 3, 10, 97, 1000)
    frame = spark.createDataFrame([(n, i) for n in sizes for i in range(n)], "n long, i long")
    frame = frame.selectExpr("n", "i", f"{mixing.permuted('i', 'n', '5L')} as v")
    got = frame.toPandas()
    assert all(sorted(g.v) == list(range(n)) for n, g in got.groupby("n")) and (got.i != got.v).mean() > 0.9
    n = 3 * 10**12  # far beyond 2^31: no repeats, places that a multiple of 2^31 - 1 parts are not moved alike
    frame = spark.createDataFrame([(n, i + k * 2147483647) for i in range(100) for k in range(10)], "n long, i long")
    got = frame.selectExpr(f"{mixing.permuted('i', 'n', '5L')} as v").toPandas().v.to_numpy()
    assert len(set(got)) == 1000 and got.min() >= 0 and got.max() < n and abs(got.mean() / n - 0.5) < 0.06 and Counter(np.diff(got.reshape(100, 10)).ravel().tolist()).most_common(1)[0][1] < 45


def test_mix_counts_of_shards(spark):
    """Brute force of the draw: every slot's source by its hash, the surplus to the sources that fell short."""
    import hashlib

    quotas = {0: 700, 1: 150, 2: 31, 4: 3}
    sources = spark.createDataFrame([(i, q * 8, q * 8.0) for i, q in quotas.items()] + [(3, 0, 0.0)], "__id long, __size long, __target double")
    slots = mixing.draw(sources, 8, 64, 0).toPandas()
    total, ids = sum(quotas.values()), sorted(quotas)
    upto = np.cumsum([quotas[i] for i in ids]) / total
    drawn = {}
    for g in range(total):
        u = int(hashlib.md5(f"1:{g // 64}:{g % 64}".encode()).hexdigest()[:8], 16) / 2**32
        drawn[g // 64, g % 64] = ids[int(np.searchsorted(upto, u, "right"))]
    got = Counter(drawn.values())
    spare = [k for i in ids for k in [k for k in sorted(drawn) if drawn[k] == i][quotas[i] :]]
    short = [i for i in ids for _ in range(quotas[i] - got[i])]
    assert spare and len(spare) == len(short)
    want = drawn | dict(zip(spare, short, strict=True))
    assert {(x.shard, x.slot): x["__id"] for _, x in slots.iterrows()} == want
    assert slots.groupby("shard").size().tolist() == [64] * (total // 64) + [total % 64] * bool(total % 64)
    assert all(sorted(g.block) == list(range(quotas[i])) for i, g in slots.groupby("__id"))


def test_mix_broadcasts_no_slots(spark, monkeypatch):
    """Only tables with a row for each source are broadcast, and slots are drawn once."""
    plans, keep = [], mixing.keep
    look = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(mixing, "keep", lambda df, name: (look(df), keep(df, name))[1])
    df = spark.createDataFrame(docs(3, 100), SCHEMA)
    look(mixing.taken(df, block=16, shard_slots=8))
    look(mixing.documents(df, block=16, shard_slots=8))
    joins = {tuple(re.sub(r"#\d+L?", "", k).split(", ")) for p in plans for k in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", p)}
    assert joins <= {("__id",), ("__s",)}
    # the chance of a slot is computed in one plan of each call
    assert sum("filter(__to" in p for p in plans) == 2


def test_mix_hands_columns_on(spark):
    """Rows with equal keys and texts keep their own other columns, and names of the plan's columns are free."""
    r = random.Random(4)
    texts = [" ".join(f"u{r.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    df = spark.createDataFrame([(i % 3, texts[i // 2], "s", i, f"  {i}") for i in range(60)], "doc_id long, text string, source string, begin long, pass string").repartition(3)
    out = mixing.documents(df, block=16, shard_slots=8).toPandas()
    assert list(out.columns) == df.columns and set(out.begin) == set(range(60))
    for x in out.itertuples():
        assert x.doc_id == x.begin % 3 and x[5] == f"  {x.begin}" and words(x.text) and f" {x.text.strip()} " in f" {texts[x.begin // 2]} " or len(words(x.text)) < 40


def test_mix_odd_rows(odd, none):
    out = mixing.taken(odd).toPandas()
    assert len(out) == len(ODD) and (out.taken <= 2 * out["size"]).all()
    assert mixing.taken(none).count() == 0 and mixing.documents(none).count() == 0
    assert mixing.documents(odd.withColumnRenamed("n_chars", "size")).columns == ["doc_id", "text", "lang", "source", "size"]


# sharding


def test_interleaving(spark, odd, none):
    rows = docs(3, 503)
    out = sharding.interleave(spark.createDataFrame(rows, SCHEMA).repartition(4), 7).toPandas()
    sizes = out.groupby("shard").size()
    assert len(out) == 503 and len(sizes) == 7 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    for _, g in out.groupby("source", dropna=False):  # every shard has the mixture
        per = g.groupby("shard").size().reindex(range(7), fill_value=0)
        assert per.max() - per.min() <= 2
    # brute force: rank by hash within the source, sort by fractional rank
    import hashlib

    h = lambda k: int(hashlib.md5(f"0:{k}".encode()).hexdigest()[:8], 16)
    by = defaultdict(list)
    for k, _, _, s, _ in rows:
        by["n" if s is None else "s" + s].append(k)
    want = sorted(((2 * i + 1) / (2 * len(v)), s, k) for s, v in by.items() for i, k in enumerate(sorted(v, key=lambda k: (h(k), k))))
    assert [k for *_, k in want] == out.sort_values(["shard", "slot"]).doc_id.tolist()
    assert sharding.interleave(odd, 3, ties=("text",)).count() == len(ODD) and sharding.interleave(none, 3).count() == 0
    assert sharding.interleave(odd.withColumnRenamed("lang", "shard"), 3).columns == ["doc_id", "text", "source", "n_chars", "shard", "slot"]


# quality


def repeats(w):
    return [max([next((k for k in range(len(w)) if i + k >= len(w) or j + k >= len(w) or w[i + k] != w[j + k]), 0) for j in range(len(w)) if j != i] or [0]) for i in range(len(w))]


def test_suffix_array_repeats():
    r = random.Random(4)
    for _ in range(150):
        texts = [[r.randrange(r.choice([2, 4, 30])) for _ in range(r.randrange(0, 30))] for _ in range(r.randrange(1, 4))]
        got = quality.repeats(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
        assert got.tolist() == sum([repeats(t) for t in texts], [])


def test_quality_counts(spark, odd, none):
    r = random.Random(5)
    rows = []
    for i in range(60):
        w = [r.choice(["a", "b#", "c|d", "e", "ü"]) for _ in range(r.randrange(0, 60))]
        rows.append((i, "".join(x + r.choice([" ", "\n", "  "]) for x in w) * r.choice([1, 1, 2])))
    out = {x.doc_id: x for x in quality.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        w = words(t)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        marked = {i + j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if x.split()]
        x = out[k]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (len(w), sum(len(y.decode()) for y in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))
        assert x.base_failed == (len(w) < 20 or 100 * len(marked) > 30 * len(w)) and not (x.base_failed and x.kept)
        assert x.covered_words == sum(s.end - s.begin for s in x.repeat_spans)
    assert quality.measure(odd).count() == len(ODD) and quality.measure(none).count() == 0
    clash = quality.measure(odd.withColumnRenamed("lang", "kept")).columns
    assert clash.count("kept") == 1 and clash[:2] == ["doc_id", "text"]


def test_quality_keeps_clean_and_rejects_repeated(spark):
    r = random.Random(6)
    clean = " ".join(f"w{r.randrange(5000)}" for _ in range(400))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, clean), (2, f"{clean} {passage} {clean[:300]} {passage}"), (3, "header line here\n" + clean + "\nheader line here")]
    kept = {x.doc_id: x.kept for x in quality.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: True, 2: False, 3: True}


# near duplicates


def shingles(t):
    w = (t or "").encode().translate(FOLD).split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def linked(rows):
    sets, parent, index = [shingles(t) for _, t in rows], list(range(len(rows))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in index[g]).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            index[g].append(i)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return sorted(((k, len(sets[i]), low.get(root(i))) for i, (k, _) in enumerate(rows)), key=str)


def families(seed, bases, copies, edits, vocabulary):
    r = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [str(r.randrange(vocabulary)) for _ in range(r.choice([3, 5, 8, 25, 70, 140]))]
        for _ in range(r.randrange(1, copies)):
            w = list(r.choice([base, base, rows[-1][1].lower().split()])) if rows else list(base)
            for _ in range(r.randrange(0, edits)):
                p = r.randrange(len(w))
                w[p : p + r.choice([0, 1, 1])] = [str(r.randrange(vocabulary))] * r.choice([0, 1, 1]) or ([] if len(w) > 1 else [w[p]])
            rows.append((r.randrange(10**6), " ".join(w or ["z"])))
    return rows


@pytest.mark.parametrize("case", [(1, 25, 14, 7, 3000), (2, 2, 120, 9, 4000), (3, 40, 10, 4, 12)])
def test_jaccard_components(spark, case):
    rows = families(*case) + [(None, None), (None, ""), (5, " "), (None, "a b c d e f"), (7, "a b c d e f"), (8, "A"), (9, "a")]
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == linked(rows)


def test_jaccard_odd_rows(odd, none):
    got = jaccard_join.link(odd).collect()
    assert sorted(map(tuple, got), key=str) == linked([(r[0], r[1]) for r in ODD]) and jaccard_join.link(none).count() == 0


def test_jaccard_tables_go_early(spark, monkeypatch):
    """When the stars begin, only the members and the table with the sets are left, and shuffles are freed."""
    left, seen, keep, drop = {}, [], jaccard_join.keep, jaccard_join.drop

    def kept(df, name):
        seen.append((name, sorted(left.values())))
        out, path = keep(df, name)
        left[path] = name
        return out, path

    monkeypatch.setattr(jaccard_join, "keep", kept)
    monkeypatch.setattr(jaccard_join, "drop", lambda spark, *paths: (drop(spark, *paths), [left.pop(x, None) for x in paths]))
    monkeypatch.setattr(jaccard_join, "settle", lambda spark: seen.append(("settle", None)))
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 50 + i % 4])) for i in range(12)]
    assert {x.component_id for x in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}
    at = [n for n, _ in seen].index("firsts")
    assert seen[at][1] == ["dense-again", "members"] and seen[at - 1][0] == "settle" and [n for n, _ in seen].count("settle") >= 7


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {x.v: x.label for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for a, b in edges if a != b for v in (a, b)}


def test_passages(spark, odd, none):
    r = random.Random(8)
    text = lambda n: [f"u{r.randrange(10**7)}" for _ in range(n)]
    shared, near = text(56), text(120)
    rows, expect = [], set()
    for i in range(80):
        w = text(r.randrange(0, 300))
        if i % 4 == 0:
            p = r.randrange(len(w) + 1)
            w[p:p] = shared
            expect.add(i)
        elif i % 10 == 1:
            copy = list(near)
            copy[r.randrange(120)] = f"edit{i}"
            w += copy
            expect.add(i)
        rows.append((i, " ".join(w)))
    rows += [(100, rows[2][1] + " " + " ".join(text(60))), (101, " ".join(["again"] * 400))]
    out = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).toPandas()
    found = set(out.doc_id)
    assert expect <= found and found <= expect | ({2, 100} if len(words(rows[2][1])) >= 40 else set())
    held = {k: words(t) for k, t in rows}
    assert all(0 <= x.begin < x.end <= len(held[x.doc_id]) for x in out.itertuples())
    assert 0 in set(out[~out.removed].doc_id) and (out[out.doc_id == 4].removed).any()
    assert passages.repeated(odd).count() == 0 and passages.repeated(none).count() == 0


def passage_links(rows, o):
    """Pairs of documents with a pair of paragraphs in one band key and at the threshold."""
    batch, values, at = passages.paragraphs([t for _, t in rows], o)
    sets = [frozenset(values[p : p + o.size - 4].tolist()) for p in at.tolist()]
    owner = [rows[d][0] for d in batch.doc[at].tolist()]
    out = set()
    for key in passages._bands(values, at, o):
        by = defaultdict(list)
        for i, k in enumerate(key.tolist()):
            by[k].append(i)
        out |= {(owner[i], owner[j]) for v in by.values() for i in v for j in v if owner[i] < owner[j] and len(sets[i] & sets[j]) >= o.threshold * len(sets[i] | sets[j])}
    return out


@pytest.mark.parametrize("hot, few", [(4096, 24), (4096, 1), (3, 24)])
def test_passages_of_a_key_are_all_compared(spark, monkeypatch, hot, few):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "FEW", few)
    r, rows = random.Random(15), []
    for f in range(200):  # one pair that links, and ten others that meet it but do not link
        for edits in [(), (25,), *[(r.randrange(6, 16), r.randrange(34, 46)) for _ in range(10)]]:
            rows.append((len(rows), " ".join(f"f{f}u{i}" if i not in edits else f"f{f}e{len(rows)}p{i}" for i in range(51))))
    batch, _, at = passages.paragraphs([t for _, t in rows], passages.Options())
    rows = [row for row, n in zip(rows, np.bincount(batch.doc[at], minlength=len(rows)), strict=True) if n == 1]
    expect = passage_links(rows, passages.Options())
    out = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).toPandas()
    held = out.groupby("doc_id").cluster.agg(set).to_dict()
    assert len(expect) > 20 and not {k for pair in expect for k in pair} - set(held)
    assert not [pair for pair in expect if not held[pair[0]] & held[pair[1]]]


def test_passages_of_hot_keys_make_no_pairs(spark, monkeypatch):
    """One key with many contents, most of which do not link: no table has a row for each two of them."""
    rows_of = {}
    for module in (passages, components, jaccard_join):
        def kept(df, name, keep=module.keep):
            out, path = keep(df, name)
            rows_of[name] = max(rows_of.get(name, 0), out.count())
            return out, path
        monkeypatch.setattr(module, "keep", kept)
    monkeypatch.setattr(passages, "HOT", 100)
    r, rows = random.Random(21), []
    for i in range(500):
        p = r.randrange(5, 46)
        rows.append((i, " ".join(f"u{k}" if k != p else f"edit{i}" for k in range(51))))
    expect = passage_links(rows, passages.Options())
    out = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).toPandas()
    held = out.groupby("doc_id").cluster.agg(set).to_dict()
    assert len(expect) > 500 and not [p for p in expect if not held[p[0]] & held[p[1]]]
    assert max(rows_of.values()) < 20 * len(rows)


def test_parts_of_a_key_all_meet(spark):
    hot = [(m, g, g * 7) for m, k in ((1, 25), (2, 11)) for g in range(k)]
    out = passages._parts(spark.createDataFrame(hot, "met long, gid long, place long"), 10).toPandas()
    met = defaultdict(set)
    for x in out.itertuples():
        met[x.met].add(x.gid)
    for k in (25, 11):
        assert all(any({a, b} <= group for group in met.values()) for a in range(k) for b in range(k))
    assert len(out) == 25 * 3 + 11 * 2


def test_widen_against_pairs():
    """The index that shrinks as components grow finds the components of all pairs."""
    r, o = np.random.default_rng(5), passages.Options()
    sets = []
    for f in range(6):
        base = r.choice(400, 30, replace=False) + 300 * f
        sets += [np.unique(np.where(r.random(30) < 0.08, r.integers(0, 3000, 30), base)) for _ in range(40)]
    sets = [sets[i].astype("<u4") for i in r.permutation(len(sets))]
    n = np.array([len(x) for x in sets])
    k = len(sets)
    gid, place = np.arange(k) // 3, np.arange(k) * 17
    got = passages._widen(np.arange(k), o, np.concatenate(sets), np.cumsum(n) - n, n, gid, place)
    want = np.arange(k)
    link = lambda i, j: (gid[i] != gid[j] or abs(place[i] - place[j]) >= o.size) and (c := len(np.intersect1d(sets[i], sets[j]))) >= o.threshold * (n[i] + n[j] - c)
    pairs = [(i, j) for i in range(k) for j in range(i) if link(i, j)]
    for _ in range(k):
        for i, j in pairs:
            want[i] = want[j] = min(want[i], want[j])
    assert len(pairs) > 100 and (got == want).all()


def test_passage_recall_on_families_of_twins(spark):
    """Brute force over all pairs of paragraphs, whatever their band keys: how many documents with a
    partner at the threshold are found."""
    r, rows, o = random.Random(17), [], passages.Options()
    for f in range(60):
        base = [f"f{f}u{i}" for i in range(60)]
        for m in range(5):
            copy = list(base)
            for p in r.sample(range(60), r.choice([3, 4])):
                copy[p] = f"f{f}m{m}p{p}"
            twin = list(copy)
            twin[r.randrange(60)] = f"f{f}t{m}"
            rows += [(len(rows), " ".join(copy)), (len(rows) + 1, " ".join(twin))]
    batch, values, at = passages.paragraphs([t for _, t in rows], o)
    index, sets, owner = defaultdict(list), [], []
    have, twins = set(), set()
    for i, (p, d) in enumerate(zip(at.tolist(), batch.doc[at].tolist(), strict=True)):
        sets.append(frozenset(values[p : p + o.size - 4].tolist()))
        owner.append(d)
        for j, n in Counter(j for g in sets[i] for j in index[g]).items():
            if owner[j] != d and n >= o.threshold * len(sets[i] | sets[j]):
                have |= {d, owner[j]}
                if sets[i] != sets[j]:
                    twins |= {d, owner[j]}
        for g in sets[i]:
            index[g].append(i)
    found = set(passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).toPandas().doc_id)
    assert len(have) > 300 and found <= have and len(found & have) >= 0.95 * len(have) and len(found & twins) >= 0.95 * len(twins)


# decontamination


def naive_tiles(a, b, least):
    fa, fb, total = [1] * len(a), [1] * len(b), 0
    while True:
        found = []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and fa[i + k] and fb[j + k]:
                    k += 1
                found.append((k, i, j))
        best = max(found, default=(0,))[0]
        if best < least:
            return total
        for k, i, j in found:
            if k == best and all(fa[i : i + k]) and all(fb[j : j + k]):
                fa[i : i + k], fb[j : j + k], total = [0] * k, [0] * k, total + k


def test_tiling():
    r = random.Random(9)
    for _ in range(200):
        a, b = ([r.randrange(r.choice([3, 8, 50])) for _ in range(r.randrange(0, n))] for n in (30, 18))
        a[3:3] = b[len(b) // 2 :] + b[: len(b) // 2]
        got = decontaminate.tiles(np.array(a, np.uint64) * 7919, np.array(b, np.uint64) * 7919, 3)
        assert sum(n for *_, n in got) == naive_tiles(a, b, 3) and all(a[p : p + n] == b[q : q + n] for p, q, n in got)


def test_decontamination(spark, odd, none):
    r = random.Random(10)
    text = lambda n: [f"u{r.randrange(10**6)}" for _ in range(n)]
    items = [(i, text(30)) for i in range(5)] + [(5, text(3)), (6, []), (7, None)]
    rows = [(0, text(100)), (1, text(20) + items[0][1] + text(20)), (2, text(9) + items[1][1][15:] + text(4) + items[1][1][:15]), (3, text(40) + items[2][1][:8]), (4, [w.upper() + "," for w in items[3][1]]), (5, text(5) + items[5][1] + text(5))]
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in rows] * 2, "doc_id long, text string")
    bench = spark.createDataFrame([(i, None if w is None else " ".join(w)) for i, w in items], "item_id long, text string")
    found = Counter((x.doc_id, x.item_id) for x in decontaminate.contaminated(frame, bench).collect())
    assert found == {(1, 0): 2, (2, 1): 2, (4, 3): 2, (5, 5): 2}
    assert Counter(x.doc_id for x in decontaminate.clean(frame, bench).collect()) == {0: 2, 3: 2}
    assert decontaminate.clean(odd, bench).count() == len(ODD) and decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(frame, bench.limit(0)).count() == 0 and decontaminate.clean(odd, bench).columns == odd.columns


def test_decontamination_of_short_tiles(spark):
    r = random.Random(16)
    item = [f"i{k}" for k in range(40)]
    pieces = [item[k : k + 5] for k in range(0, 40, 5)]
    r.shuffle(pieces)
    changed = [w if k % 5 else f"x{k}" for k, w in enumerate(item)]
    rows = [(0, [w for piece in pieces for w in [*piece, f"y{piece[0]}"]]), (1, changed), (2, item[:4] + ["z"] + item[10:14]), (3, [w for w in item for _ in (0, 1)])]
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    found = {x.doc_id: x.coverage for x in decontaminate.contaminated(frame, bench).collect()}
    assert found == {k: naive_tiles(w, item, 4) / 40 for k, w in rows if naive_tiles(w, item, 4) >= 20} and set(found) == {0, 1}
    with pytest.raises(ValueError):
        decontaminate.Options(seed=6)


# token files


@pytest.mark.parametrize("n", [0, 1, 63, 256, 257, 3000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 300, 50257, 2**32 - 1):
        ids = rng.integers(0, high, n, dtype=np.uint32)
        ids[rng.integers(0, n, 2) if n else []] = high - 1
        f = token_files.TokenFile(token_files.encode_file([3, None], np.array([n, 0]), ids))
        assert (f.ids() == ids).all() and (f.ids(1, 2) == ids[256:512]).all() and f.null.tolist() == [0, 1]


def test_encoder_equals_tokenizer():
    e, r = token_files.Encoder(tokenizer_path()), random.Random(11)
    signs = ["<|endoftext|>", "<|end", "a", "Word", " ", "  ", "\n", "\t", " ", "'s", " the", "12", "é", "🙂", "!", "\r\n", "\x1c", " ", "²", "_", ",", "中", ".", "%"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(0, 14))) for _ in range(4000)] + [None, ""]
    fresh = Tokenizer.from_file(tokenizer_path())
    for got, t in zip(e(texts), texts, strict=True):
        assert got.tolist() == fresh.encode(t or "", add_special_tokens=False).ids


def test_encoder_is_given_up():
    path = tokenizer_path()
    held = token_files.encoder(path)
    assert token_files.encoder(path, kept=False) is held and path not in token_files._encoders
    assert token_files.encoder(path, kept=False) is not held and path not in token_files._encoders


def test_token_files(spark, odd, none):
    frame = odd.union(spark.createDataFrame([(k, t, *_) for k, t, *_ in docs(12, 80)] + [(99, "a <|endoftext|> b<|endoftext|>", None, None, 0)], SCHEMA)).repartition(5)
    out = token_files.round_trip(frame, tokenizer_path(), files=4).toPandas()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    signed = lambda t: 42 if t is None else (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 - 2**63
    rows = sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda x: (x[0] is not None, x[0] or 0, signed(x[1]), (x[1] or "").encode()))
    at, want = 0, []
    for k, t in rows:
        ids = np.append(tokenizer.encode(t or "", add_special_tokens=False).ids, 2).astype("<u4")
        want.append((at, len(ids), zlib.crc32(ids.tobytes()), k))
        at += len(ids)
    got = sorted((int(x.start), int(x.n_tokens), int(x.ids_crc32), None if np.isnan(x.doc_id) else int(x.doc_id)) for x in out.itertuples())
    assert got == want and token_files.round_trip(none, tokenizer_path()).count() == 0


# labels


def test_language_id(spark, odd, none):
    r = random.Random(13)
    syllables = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "ein", "er"], "zz": ["ción", "ado", "os", "ar"]}
    rows = [(i, " ".join("".join(r.choice(syllables[k]) for _ in range(3)) for _ in range(r.randrange(3, 60))), k) for i in range(240) for k in [r.choice(list(syllables))]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(frame, frame.doc_id % 4 != 0, langid.Options(per_class=100))
    out = langid.predict(frame, model).collect()
    assert np.mean([x.lang_pred == x.lang for x in out if x.doc_id % 4 == 0]) > 0.95 and all(0 <= x.score <= 1 for x in out)
    strange = langid.predict(odd, model).toPandas()
    assert len(strange) == len(ODD) and (strange.lang_pred[strange.text.isna()] == "und").all() and langid.predict(none, model).count() == 0
    signs = spark.createDataFrame([(1, "", "old"), (2, "12 34 ²", "old"), (3, "!? -- _", "old"), (4, "kalo", "old")], "doc_id long, text string, lang_pred string")
    assert {x.doc_id: (x.lang_pred, x.score) for x in langid.predict(signs, model).collect() if x.doc_id < 4} == {k: ("und", 0.0) for k in (1, 2, 3)}
    many = spark.createDataFrame([(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} x", f"l{i}") for i in range(1100)], "doc_id long, text string, lang string")
    assert len(langid.fit(many, many.doc_id >= 0, langid.Options(buckets=256, epochs=1, per_class=1)).classes) == 1100
    assert set(langid.predict(odd, langid.fit(none, none.doc_id > 0)).toPandas().lang_pred) == {"und"}


def test_toxicity(spark, odd, none):
    r = random.Random(14)
    rows, labels = [], []
    for i in range(400):
        w = [" ".join(f"c{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}l" for _ in range(8)) + "." for _ in range(6)]
        bad = i % 4 == 0
        if bad:
            w[r.randrange(6)] = "some vilest" + r.choice(["ab", "cd", "ef"]) + " thing."
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    tags = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(frame, tags, tags.doc_id % 5 != 0)
    out = toxicity.score(frame, model).collect()
    assert np.mean([x.predicted == (x.doc_id % 4 == 0) for x in out if x.doc_id % 5 == 0]) > 0.95
    for x in out:
        if x.predicted:
            s = x.offending[0]
            assert b"vilest" in b" ".join(words(x.text)[s.begin : s.end])
    strange = toxicity.score(odd, model).toPandas()
    assert len(strange) == len(ODD) and strange.score.between(0, 1).all() and (strange.score[strange.text.isna()] == 0).all()
    few = toxicity.fit(frame, tags, tags.doc_id % 5 != 0, toxicity.Options(chars=4000))
    assert not np.array_equal(few.weights, model.weights) and few.weights.any()
    assert toxicity.fit(frame, tags, tags.doc_id % 5 != 0, toxicity.Options(chars=10)).weights.any() == np.False_
    assert toxicity.score(none, model).count() == 0 and toxicity.score(odd, toxicity.fit(none, tags, tags.doc_id > 0)).count() == len(ODD)


# URL filters


def test_url_filter(spark):
    entries = [("l", "block", "host", "a.b.org", "add", 10), ("l", "block", "host", "a.b.org", "remove", 20), ("l", "block", "host", "a.b.org", "add", 30), ("m", "block", "domain", "c.org", "add", 0), ("n", "block", "prefix", "d.org/x/", "add", 5), ("ok", "allow", "host", "s.c.org", "add", 50), (None, "block", "host", "z", "add", 1)]
    captures = [("http://a.b.org/p", 9), ("http://a.b.org/p", 10), ("http://A.b.org:80/p?q", 19), ("http://a.b.org", 20), ("http://u@a.b.org./", 35), ("https://s.c.org/", 40), ("https://s.c.org/", 60), ("http://xc.org", 60), ("http://d.org/x/y#z", 6), ("http://d.org/xy", 6), (None, 6), ("nothing", 6), ("http://c.org", None), ("http://a.b.org/p", 10)]
    frame = spark.createDataFrame([(i, u, t, "old") for i, (u, t) in enumerate(captures)], "page_id long, url string, fetched_at long, kept string")
    log = spark.createDataFrame(entries, "list string, effect string, kind string, pattern string, action string, at long")
    out = {x.page_id: x for x in url_filter.filter_urls(frame, log).collect()}
    assert [out[i].kept for i in range(len(captures))] == [True, False, False, True, False, False, True, True, False, True, True, True, True, False]
    assert out[5].blocked_by == "m" and out[6].active == 2 and len(out) == len(captures)
    assert url_filter.filter_urls(frame, log.limit(0)).filter("kept").count() == len(captures) and url_filter.filter_urls(frame.limit(0), log).count() == 0
