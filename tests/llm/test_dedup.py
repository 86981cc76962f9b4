"""Exact, near-duplicate and line deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import assert_same, connect
from sievestone.llm import content_sort, digest_filter, line_runs, near_copies, simhash
from sievestone.llm.queries import ORACLES, QUERIES

#: Columns of documents, and of other names that the operators use inside.
CLASHING = ["score", "row", "fp", "run", "_kept", "_lines", "_t1", "_t2", "_gone", "_simhash_row", "_digest", "_held", "_row", "_text", "_score", "doc", "kept", "lines", "gone", "t1", "h1", "key", "node", "label", "n", "text_sha256", "_page", "_bit", "_bits", "_maybe", "item", "item_id", "at", "toxic"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASHING)
SPACE = " \t\n\x0b\x0c\r"


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), *(7 * k + len(t or "") for k in range(len(CLASHING)))) for i, t in rows], DOCS)


def odd_rows():
    rng = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    base = " ".join(rng.choice(words) for _ in range(200))
    rows = [(k, base.replace("w1 ", f"v{k} ", 1)) for k in range(30)]
    rows += [(100 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for k in range(60)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "two words"), (206, "a b İ Ü"), (207, base.upper()), (207, base.upper()), (None, base), (None, None), (208, "x " * 30_000)]
    rows += [(300 + k, "the same text  here") for k in range(80)]
    return rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, small, name):
    assert_same(QUERIES[name](spark, small).toPandas(), connect(small).sql(ORACLES[name]).df())


def expected_exact(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        out.append((i, min((j for j in ids if j is not None), default=None), len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return out


def test_exact_groups_of_odd_rows(spark):
    rows = odd_rows()
    made = content_sort.exact_groups(docs(spark, rows).repartition(7)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in made), key=key) == sorted(expected_exact(rows), key=key)
    kept = Counter(r["text_sha256"] for r in made if r["kept"])
    assert set(kept) == {r["text_sha256"] for r in made} and set(kept.values()) == {1}
    assert all(r["doc_id"] == r["keep_id"] for r in made if r["kept"])


def test_a_text_that_most_rows_share_spans_partitions(spark):
    rows = [(k, "hot text" if k % 3 else f"cold {k}") for k in range(3000)]
    made = content_sort.exact_groups(docs(spark, rows).repartition(16)).collect()
    assert {(r["keep_id"], r["group_size"]) for r in made if r["doc_id"] % 3} == {(1, 2000)}
    assert sum(r["kept"] for r in made) == 1001


def expected_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected_components(prints):
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if (a ^ b).bit_count() <= 2 and find(a) != find(b):
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def check_components(rows, made):
    prints = {r: expected_print(t) for r, (_, t) in enumerate(rows)}
    root = expected_components(prints.values())
    least = {}
    for r, (i, _) in enumerate(rows):
        if i is not None:
            least[root[prints[r]]] = min(i, least.get(root[prints[r]], i))
    expected = Counter((i, f"{prints[r]:016x}", least.get(root[prints[r]])) for r, (i, _) in enumerate(rows))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in made) == expected


def test_near_components_of_odd_rows(spark):
    rows = odd_rows()
    check_components(rows, simhash.near_components(docs(spark, rows)).collect())


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("crowded", [False, True])
def test_links_connect_all_pairs(spark, crowded):
    """A crowd around few centres, and prints that differ from it in single parts, with the crowd's way forced or not."""
    rng = random.Random(3)
    values = set()
    for centre in [rng.getrandbits(64) for _ in range(4)]:
        for _ in range(400):
            v = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << b
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(300)}
    before = simhash.CROWD_COST
    simhash.CROWD_COST = 0 if crowded else before
    try:
        edges = simhash.links(spark.createDataFrame([(signed(v),) for v in values], "fp long")).collect()
    finally:
        simhash.CROWD_COST = before
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 2 for r in edges)
    parent = {signed(v): signed(v) for v in values}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for r in edges:
        parent[find(r["a"])] = find(r["b"])
    root = expected_components(values)
    groups = lambda m: Counter(Counter(m.values()).values())
    assert groups({v: find(signed(v)) for v in values}) == groups(root)


def test_allocation_covers_every_pair():
    """For any histogram, thresholds sum to radius - parts + 1."""
    rng = np.random.default_rng(5)
    fp = rng.integers(-(1 << 62), 1 << 62, 500)
    for parts in (2, 3, 4):
        groups = [list(range(k, 64, parts)) for k in range(parts)]
        histogram = rng.integers(0, 1000, (parts, simhash.CELLS)).astype(float)
        t, cost = simhash.allocate(simhash.part_values(fp, groups), [len(g) for g in groups], histogram, 2)
        assert (t.sum(1) == 2 - parts + 1).all() and t.min() >= -1 and np.isfinite(cost).all()


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    groups = simhash.group_bits(bits.T.astype(float) @ bits, 4000, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({3, 40} <= set(g) for g in groups)


def test_one_of_each_near_group_stays(spark):
    rows = odd_rows()
    source = docs(spark, rows)
    kept = simhash.keep_one(source)
    assert kept.columns == source.columns
    comp = [(r["doc_id"], r["component_id"]) for r in simhash.near_components(source).collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in comp})


def test_empty_tables(spark):
    none = docs(spark, [])
    assert content_sort.exact_groups(none).count() == 0
    assert simhash.near_components(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    assert line_runs.line_report(none).count() == 0
    assert line_runs.without_lines(none).columns == none.columns


def expected_lines(rows, min_docs=10):
    key = lambda s: "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in s.strip(SPACE))
    count = Counter(k for _, t in rows for k in {key(s) for s in (t or "").split("\n")})
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [s for s in all_lines if not key(s) or count[key(s)] < min_docs]
        out.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def line_rows():
    rng = random.Random(9)
    rows = [(k, "\n".join(rng.choice(["Shared\r", " shared", "\tÄber", "äber", f"own {k}", "", "rare", " x "]) for _ in range(rng.randint(1, 12)))) for k in range(60)]
    return rows + [(70, None), (71, ""), (72, "\n\n"), (73, "SHARED"), (None, "shared\nlast"), (74, "shared\n" * 3000), (60, "rare"), (60, "rare")]


@pytest.mark.parametrize("limit", [0, 500_000])
def test_lines_of_odd_rows(spark, limit):
    before = line_runs.BROADCAST_LINES
    line_runs.BROADCAST_LINES = limit
    try:
        made = line_runs.line_report(docs(spark, line_rows())).collect()
    finally:
        line_runs.BROADCAST_LINES = before
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in made) == expected_lines(line_rows())


def test_lines_that_stay(spark):
    rows = line_rows()
    made = line_runs.without_lines(docs(spark, rows))
    expected = expected_lines(rows)
    got = Counter(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in made.collect())
    assert got == Counter({h: n for h, n in Counter(x[3] for x in expected.elements()).items()})
    assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in made.collect())


def test_runs_leave_no_tables(spark):
    rows = docs(spark, [(k, "one\ntwo") for k in range(12)])
    assert line_runs.frequent_lines(rows).count() == 2
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_runs_by_level(spark):
    runs = line_runs.LineRuns(spark, min_docs=3, fanout=2)
    for _ in range(5):
        runs.add(spark.createDataFrame([(1, 1, 1), (2, 2, 3)], "h1 long, h2 long, docs long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(r["h1"], r["docs"]) for r in runs.total().collect()} == {(1, 3), (2, 3)}  # settled digests are not counted on
    assert runs.frequent().count() == 2


def test_runs_merge_without_shuffle_or_sort(spark, monkeypatch):
    runs, plans = line_runs.LineRuns(spark, min_docs=3, fanout=2), []
    write = runs.write
    monkeypatch.setattr(runs, "write", lambda rows: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(rows))[1])
    dealt = write(spark.range(1000).selectExpr("id AS h1", "id AS h2", "id AS first").repartition(runs.buckets, "h1", "h2"))
    for k in range(5):
        runs.add(dealt.where(f"first >= {100 * k}").selectExpr("h1", "h2", "1L AS docs"), dealt=True)
    total = runs.total()
    assert len(plans) == 5 + 3 + 1  # runs, compactions, and the last merge
    assert [p for p in plans if "Exchange" in p or "Sort " in p or "Bucketed: true" not in p] == []
    assert {(r["docs"], r["count"]) for r in total.groupBy("docs").count().collect()} == {(1, 100), (2, 100), (3, 800)}


def clashing_rows():
    return [*line_rows(), *((300 + k, t) for k, t in near_texts()), (900, "w " * 6), (901, None), (None, "null id")]


@pytest.mark.parametrize("stage", range(4))
def test_stages_leave_columns_of_any_name_alone(spark, stage):
    import os

    import corpus_pipeline

    assert os.path.exists(corpus_pipeline.__file__)
    name, run = corpus_pipeline.STAGES[stage]
    source = docs(spark, clashing_rows())
    kept = run(spark, source, "/root/testdata/sf0.001")
    assert kept.columns == source.columns and kept.dtypes == source.dtypes
    of = lambda df: Counter((r["doc_id"], *(r[c] for c in CLASHING)) for r in df.collect())
    made, all_rows = of(kept), of(source)
    assert made and not made - all_rows, name
    assert name == "simhash_dedup" or made == all_rows


@pytest.mark.parametrize("pages", [1, 8])
def test_digest_filter_is_exact(spark, pages):
    rows = spark.createDataFrame([(str(k % 5000) if k % 97 else None, k) for k in range(20_000)], "d string, k int")
    listed = spark.createDataFrame([(str(k),) for k in range(0, 9000, 3)], "d string")
    names = {str(k) for k in range(0, 9000, 3)}
    inside = sorted(r["k"] for r in digest_filter.among(rows, listed, ["d"], pages).collect())
    assert inside == sorted(k for k in range(20_000) if k % 97 and str(k % 5000) in names)
    outside = sorted(r["k"] for r in digest_filter.without(rows, listed, ["d"], pages).collect())
    assert outside == sorted(set(range(20_000)) - set(inside))
    maybe, _ = digest_filter.split(rows, listed, ["d"], 8)
    assert maybe.count() < 1.2 * len(inside)
    assert digest_filter.without(rows, listed.where("false"), ["d"]).count() == 20_000


def near_texts():
    """Texts with edits on both sides of similarity 0.8, a crowd around one text, and texts with repeats."""
    rng = random.Random(21)
    text = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    rows, crowd = [], text(120)
    for k in range(40):
        base = text(rng.choice([5, 9, 60, 100, 300]))
        for _ in range(3):
            new = list(base)
            for _ in range(rng.randint(0, 3)):
                new[rng.randrange(len(new))] = "changed"
            rows.append(" ".join(new))
    for k in range(80):
        new = list(crowd)
        for _ in range(rng.randint(1, 4)):
            new[rng.randrange(len(new))] = f"v{k}"
        rows.append(" ".join(new))
    rows += ["a b c d", "A  b c d", "a b c e", "", None, "again " * 50, "again " * 60, "again " * 80]
    rng.shuffle(rows)
    return list(enumerate(rows))


def least_of_similar(rows):
    """The smallest id of each group of texts (by id) with a weighted five-word similarity of 0.8 or more, or the same words, by all pairs."""
    words = {i: "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in t or "").translate(str.maketrans(SPACE, " " * len(SPACE))) for i, t in rows.items()}
    words = {i: [w for w in t.split(" ") if w] for i, t in words.items()}
    bags = {i: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for i, w in words.items()}
    size = {i: b.total() for i, b in bags.items()}
    parent = {i: i for i in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in words:
        for b in words:
            if b < a and (words[a] == words[b] or 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b]) > 0):
                both = (bags[a] & bags[b]).total()
                if words[a] == words[b] or 5 * both >= 4 * (size[a] + size[b] - both):
                    a_root, b_root = find(a), find(b)
                    parent[max(a_root, b_root)] = min(a_root, b_root)
    return sorted({find(i) for i in rows})


@pytest.mark.parametrize(("least_crowd", "block"), [(2, 1024), (2, 8), (16, 1024)])
def test_similar_texts_leave_one(spark, monkeypatch, least_crowd, block):
    """Against all pairs by weighted five-word similarity of 0.8, with the way of crowds for most buckets or for large ones, and in many blocks."""
    monkeypatch.setattr(near_copies, "SMALL", least_crowd)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = near_texts()
    kept = least_of_similar(dict(rows))
    beyond = [i for i in range(len(rows)) if i not in kept and all((expected_print(rows[i][1]) ^ expected_print(t)).bit_count() > 2 for j, t in rows if j != i)]
    assert len(beyond) > 20  # similar texts that op1's fingerprints do not link
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs(spark, rows)).collect()) == kept


@pytest.mark.parametrize("radius", [5, 9])
def test_links_within_a_wide_radius(spark, radius):
    """All pairs within the radius, by thresholds of the parts that sum to radius - parts + 1."""
    rng = random.Random(radius)
    values = [rng.getrandbits(64) for _ in range(500)]
    values = sorted({v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2))) for v in values[:250]} | set(values))
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    made = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in simhash.links(nodes, radius, 10_000).collect()}
    close = {(min(signed(a), signed(b)), max(signed(a), signed(b))) for k, a in enumerate(values) for b in values[:k] if (a ^ b).bit_count() <= radius}
    assert len(close) > 100 and made == close


def test_wide_thresholds_cover_every_pair():
    rng = np.random.default_rng(6)
    fp = rng.integers(-(1 << 62), 1 << 62, 300)
    for total in (200, 10_000, 200_000, 13_000_000):
        radius, cost = simhash.widest(total, near_copies.PROBE_COST, near_copies.MAX_RADIUS)
        parts = min(simhash.PARTS, key=lambda n: simhash.even_cost(total, n, radius))
        assert simhash.even_cost(total, parts, radius) == cost <= near_copies.PROBE_COST
        groups = [list(range(k, 64, parts)) for k in range(parts)]
        t, c = simhash.allocate(simhash.part_values(fp, groups), [len(g) for g in groups], rng.integers(0, 1000, (parts, simhash.CELLS)).astype(float), radius)
        assert (t.sum(1) == radius - parts + 1).all() and t.min() >= -1 and t.max() <= simhash.MAX_EACH and np.isfinite(c).all()


def test_near_copies_are_found_by_fingerprints(spark, monkeypatch):
    """The stage without its buckets: five-word fingerprints link all similar texts within the radius, and nothing else."""
    import corpus_pipeline

    rng = random.Random(8)
    rows = []
    for _ in range(60):
        base = [f"w{rng.randrange(900)}" for _ in range(250)]
        for _ in range(2):
            rows.append((len(rows), " ".join("x" if k == at else w for at in [rng.randrange(300)] for k, w in enumerate(base))))
    prints = [int(simhash.majority(near_copies.elements(t.encode().split()))) for _, t in rows]
    distinct = len({t for _, t in rows})
    radius, _ = simhash.widest(len(set(prints)), near_copies.PROBE_COST, near_copies.MAX_RADIUS)
    near = [(a ^ b) & (1 << 64) - 1 for a, b in zip(prints[::2], prints[1::2])]
    assert distinct > 80 and max(v.bit_count() for v in near) <= radius and sum(v.bit_count() > 2 for v in near) > 5
    monkeypatch.setattr(near_copies, "other_links", lambda nodes, close, *_: close.limit(0))
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 120, 2)) == least_of_similar(dict(rows))


def test_fingerprints_of_hashes_are_majorities(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    h = np.random.default_rng(2).integers(0, 1 << 63, 30, np.int64).astype(np.uint64) * np.uint64(2)
    for n in (1, 2, 7, 30):
        assert simhash.majority(h[:n]) == signed(sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[:n]) > n))
    assert simhash.majority(h[:0]) == 0
