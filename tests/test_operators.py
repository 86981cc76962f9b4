import random
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sievestone.functions import parameters
from sievestone.functions import scalars as S
from sievestone.operators import audit, compliance, evaluate, graph, hamming, labels, quarantine, ranking, splitting

LINES = ["0 0.5 0.5 0.2 0.2", "0 0.5 0.5 0.2", "a 0.5 0.5 0.2 0.2", "1.0 0.5 0.5 0.2 0.2", "7 0.5 0.5 0.2 0.2", "0 1.2 -0.1 0.2 0.2", "0 0.5 0.5 0 0.2", ""]
OK = ("", True)
GOLDEN = {
    "audit": [OK, ("bad_field_count:4", False), ("non_numeric", False), ("non_numeric", False), ("bad_class:7", True), ("xc_out_of_range;yc_out_of_range", True), ("w_out_of_range", True), None],
    "qa": [OK, ("not_5_fields", False), ("non_numeric", False), ("non_numeric", False), ("class_id_7_unexpected", False), ("center_out_of_range", False), ("size_out_of_range", False), ("not_5_fields", False)],
    "final": [OK, ("not_5_fields", True), ("non_numeric", True), ("non_numeric", True), ("class_7_not_in_mapping", True), ("coord_range", True), ("", True), ("not_5_fields", False)],
    "prepare": [OK, *[("bad", False)] * 6, None],
    "transfer": [OK, OK, ("parse_error", False), ("parse_error", False), OK, OK, OK, None],
}


@pytest.mark.parametrize("mode", sorted(GOLDEN))
def test_label_modes(spark, mode):
    rows = spark.createDataFrame([("s", k, x) for k, x in enumerate(LINES)], "stem string, line_no int, line string")
    made = {r["line_no"]: (";".join(r["errors"]), r["is_box"]) for r in labels.validate(rows, mode, [0, 1]).collect()}
    assert [made.get(k) for k in range(len(LINES))] == GOLDEN[mode]


def test_strict_modes_raise(spark):
    rows = spark.createDataFrame([("s", 0, "a 1 1 1 1")], "stem string, line_no int, line string")
    for mode in ("profile", "scan"):
        with pytest.raises(Exception, match="class is no integer|can't be read"):
            labels.validate(rows, mode, [0]).collect()


def machine(bads, confirm, clear):
    bad = ok = 0
    alerted, out = False, []
    for k, b in enumerate(bads):
        if b:
            bad, ok = bad + 1, 0
            if bad >= confirm and not alerted:
                alerted = True
                out.append(k)
        else:
            bad, ok = 0, ok + 1
            if ok >= clear:
                alerted = False
    return out


@pytest.mark.parametrize(("bads", "alerts"), [("11", []), ("1111", [2]), ("110111", [5]), ("1110111", [2]), ("11100111", [2, 7])])
def test_gate_golden(bads, alerts):
    assert machine([b == "1" for b in bads], 3, 2) == alerts


def test_gate_batch_equals_machine(spark):
    rng = random.Random(1)
    tracks = {k: [rng.random() < 0.6 for _ in range(rng.randint(1, 25))] for k in range(200)}
    rows = spark.createDataFrame([(k, n, b) for k, seq in tracks.items() for n, b in enumerate(seq)], "track long, n int, bad boolean")
    for confirm, clear in product((1, 2, 3), (1, 2, 3)):
        made = compliance.persistent(rows, "track", ["n"], "bad", confirm, clear).collect()
        assert sorted((r["track"], r["n"]) for r in made) == sorted((k, n) for k, seq in tracks.items() for n in machine(seq, confirm, clear))


def hash_rows(spark, n=250, seed=3):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = []
    for _ in range(n):
        h = rng.choice(centres)
        for _ in range(rng.randint(0, 7)):
            h ^= 1 << rng.randrange(64)
        values.append(h - (1 << 64) if h >> 63 else h)
    splits = [rng.choice(["train", "val", "test"]) for _ in range(n)]
    return list(zip(range(n), values, splits)), spark.createDataFrame(list(zip(range(n), values, splits)), "id long, h long, split string")


def distance(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count()


@pytest.mark.parametrize("t", [0, 2, 4, 8, 16])
def test_hamming_join_equals_brute_force(spark, t):
    values, rows = hash_rows(spark)
    expected = {(a, b): distance(x, y) for a, x, _ in values for b, y, _ in values if a < b and distance(x, y) <= t}
    assert {(r["a"], r["b"]): r["d"] for r in hamming.hamming_pairs(rows, t).collect()} == expected


def test_parts_cover_the_threshold():
    for t in range(0, 24):
        parts, radius = hamming.plan(t, 10_000)
        assert sum(hamming.part_widths(parts)) == 64 and parts * (radius + 1) > t


def test_components_equal_union_find(spark):
    values, rows = hash_rows(spark, seed=5)
    parent = {a: a for a, _, _ in values}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, x, _ in values:
        for b, y, _ in values:
            if a < b and distance(x, y) <= 4 and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    made = graph.grouped(rows, hamming.copy_edges(rows, 4), "id").collect()
    assert {r["id"]: r["group_id"] for r in made} == {a: find(a) for a in parent}


def test_long_chain_is_one_component(spark):
    chain = list(range(60))
    random.Random(2).shuffle(chain)
    edges = spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long")
    assert {r["label"] for r in graph.connected_components(edges).collect()} == {0}


def test_no_edges_no_components(spark):
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_quarantine_equals_greedy_loop(spark):
    values, rows = hash_rows(spark, seed=7)
    rank = {"train": 1, "val": 2, "test": 3}
    expected = {}
    for a, x, s in values:
        above = [(b, distance(x, y)) for b, y, u in values if rank[u] > rank[s] and distance(x, y) <= 4]
        if above:
            expected[a] = min(above)
    made = {r["removed"]: (r["kept"], r["distance"]) for r in quarantine.near_quarantine(rows, 4).collect()}
    assert made == expected


def test_all_later_copies_go(spark):
    pairs = spark.createDataFrame([("b", "a"), ("c", "a"), ("c", "b")], "later string, first string")
    assert {(r["removed"], r["kept"]) for r in quarantine.report_targets(pairs).collect()} == {("b", "a"), ("c", "a")}


def test_manifest_has_all_kinds(spark):
    exact = spark.createDataFrame([("b", "a", "train")], "removed string, kept string, split string")
    near = spark.createDataFrame([("d", "c", "train", 3)], "removed string, kept string, split string, distance int")
    bad = spark.createDataFrame([("e", 2)], "removed string, count long")
    none = spark.createDataFrame([("f",)], "removed string")
    assert {r["type"] for r in quarantine.manifest(exact, near, bad, none).collect()} == {"exact_duplicate", "near_duplicate", "invalid_label_lines_skipped", "missing_label"}


def deal(deficits, size, n):
    left, taken = list(deficits), [0] * len(deficits)
    for _ in range(n):
        s = max(range(len(left)), key=lambda k: (left[k], -k))
        left[s] -= size
        taken[s] += 1
    return taken


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-50, 400), min_size=3, max_size=3), st.integers(1, 30), st.integers(0, 60))
def test_fill_equals_dealing_one_by_one(deficits, size, n):
    assert splitting.fill(list(map(float, deficits)), size, n) == deal(deficits, size, n)


def test_group_split_keeps_targets(spark):
    rng = random.Random(4)
    groups = [(g, rng.choice(["a", "b"]), rng.choice([1, 1, 1, 2, 3, 20])) for g in range(400)]
    made = splitting.stratified_group_split(spark.createDataFrame(groups, "group_id long, profile string, members long"), (0.7, 0.2, 0.1)).collect()
    assert sorted(r["group_id"] for r in made) == list(range(400))
    for p in "ab":
        total = sum(m for _, q, m in groups if q == p)
        for split, ratio in zip(splitting.SPLITS, (0.7, 0.2, 0.1)):
            assert abs(sum(r["members"] for r in made if r["profile"] == p and r["split"] == split) - ratio * total) <= 20


def test_greedy_matches_equal_loop(spark):
    rng = random.Random(6)
    box = lambda: (x := rng.random(), y := rng.random(), x + 0.3 + rng.random() / 5, y + 0.3 + rng.random() / 5)
    make = lambda n: [(f"i{rng.randrange(5)}", k, rng.randrange(2), box()) for k in range(n)]
    truth, predictions = make(60), make(60)
    schema = "image string, idx int, cls int, box struct<x1: double, y1: double, x2: double, y2: double>"

    def iou(a, b):
        both = max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
        return both / max((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both, 1e-9)

    pairs = sorted((-iou(p[3], g[3]), p[1], g[1], p[0]) for p in predictions for g in truth if p[0] == g[0] and p[2] == g[2] and iou(p[3], g[3]) >= 0.3)
    used_p, used_g, expected = set(), set(), set()
    for _, p, g, image in pairs:
        if p not in used_p and g not in used_g:
            used_p.add(p)
            used_g.add(g)
            expected.add((image, p, g))
    P, G = (spark.createDataFrame(x, schema) for x in (predictions, truth))
    matches = evaluate.greedy_matches(P, G, 0.3)
    assert {(r["image"], r["pred"], r["gt"]) for r in matches.collect()} == expected
    total = {r["cls"]: r for r in evaluate.totals(evaluate.outcomes(P, G, matches)).collect()}[None]
    assert (total["tp"], total["fn"], total["fp"]) == (len(expected), 60 - len(expected), 60 - len(expected))


def test_items_go_to_the_first_of_equal_workers(spark):
    box = "struct<x1: double, y1: double, x2: double, y2: double>"
    workers = spark.createDataFrame([(1, 5, 0, (0.0, 0.0, 10.0, 20.0)), (1, 4, 1, (0.0, 0.0, 10.0, 20.0)), (2, -1, 0, (0.0, 0.0, 10.0, 20.0))], f"frame_no long, track_id long, pos long, box {box}")
    items = spark.createDataFrame([(1, 0, "helmet", (4.0, 2.0, 6.0, 4.0), 0.9), (1, 1, "boots", (4.0, 2.0, 6.0, 4.0), 0.9), (1, 2, "vest", (900.0, 900.0, 910.0, 910.0), 0.9)], f"frame_no long, item long, cls string, box {box}, conf double")
    made = compliance.assign_items(workers, items)
    assert [(r["item"], r["track_id"]) for r in made.collect()] == [(0, 5)]
    status = {(r["frame_no"], r["track_id"]): r for r in compliance.status(workers, made).collect()}
    assert status[1, 5]["missing"] == ["gloves", "goggles", "vest"] and status[2, -1]["present"] == [] and not status[1, 4]["compliant"]


def test_heads_and_uncovered_people(spark):
    box = "struct<x1: double, y1: double, x2: double, y2: double>"
    people = spark.createDataFrame([(1, 7, (0.0, 0.0, 10.0, 20.0)), (1, 8, (50.0, 0.0, 60.0, 20.0))], f"frame_no long, track_id long, box {box}")
    heads = spark.createDataFrame([(1, 0, (3.0, 0.0, 6.0, 4.0)), (1, 1, (100.0, 0.0, 104.0, 4.0))], f"frame_no long, idx long, box {box}")
    assert [(r["head"], r["track_id"]) for r in compliance.assign_heads(people, heads, 0.5).collect()] == [(0, 7)]
    vests = spark.createDataFrame([(1, (0.0, 4.0, 10.0, 14.0))], f"frame_no long, box {box}")
    assert [r["track_id"] for r in compliance.uncovered(people, vests, 0.3).collect()] == [8]


def test_ranks_do_not_depend_on_partitions(spark):
    rows = spark.range(500).withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 3))
    made = ranking.ranked(rows.repartition(7), ["k"], [ranking.seeded(1, "id"), F.col("id")]).collect()
    for key in (0, 1, 2):
        assert sorted(r["rank"] for r in made if r["k"] == key) == list(range(1, sum(r["k"] == key for r in made) + 1))


@pytest.mark.parametrize(("n", "sizes"), [(0, (0, 0, 0)), (2, (2, 0, 0)), (3, (1, 1, 1)), (10, (8, 1, 1)), (1000, (700, 200, 100)), (25, (20, 2, 3))])
def test_split_sizes(n, sizes):
    assert ranking.split_sizes(n, "auto") == sizes


def test_parameters():
    assert parameters.parse_ratio("7:2:1", 5) == (0.7, 0.2, 0.1)
    with pytest.raises(ValueError, match="three"):
        parameters.parse_ratio("1:1", 5)
    assert parameters.parse_class_map("0:smoke,1:fire") == {0: "smoke", 1: "fire"}
    assert parameters.read_class_names(["names:", "  1: b", "  0: a"]) == ["a", "b"] == parameters.class_names({"names": ["a", "b"]})
    with pytest.raises(ValueError, match="vest"):
        parameters.require_classes(["helmet"], ["helmet", "vest"])


def test_scalars(spark):
    row = spark.range(1).select(
        S.source_key(F.lit("/x/a.b.rf." + "0" * 32 + ".jpg")).alias("key"), S.series_key(F.lit("/x/WEB12.jpg")).alias("web"), S.series_key(F.lit("/x/ab12.jpg")).alias("series"),
        S.json_text(F.lit('{"a": ""}'), "$.a").alias("empty"), S.is_secret_file(F.lit("/x/a.PEM")).alias("pem"), S.pack_bits(F.array(*[F.lit(True)] * 64)).alias("bits"),
        S.label_line(F.lit(1), F.lit(0.5), F.lit(0.25), F.lit(1.0), F.lit(0.125)).alias("line"), S.mime_suffix(F.lit("image/gif")).alias("gif"),
    ).first()
    assert (row["key"], row["web"], tuple(row["series"]), row["empty"], row["pem"], row["bits"]) == ("a.b", None, ("ab", 12), "Unknown", True, -1)
    assert (row["line"], row["gif"]) == ("1 0.500000 0.250000 1.000000 0.125000", ".gif")
    with pytest.raises(Exception, match="unknown kind"):
        spark.range(1).select(S.source_kind(F.lit("a.txt"))).collect()


def test_upper_median_of_nothing(spark):
    rows = spark.createDataFrame([("a", None), ("b", 1.0), ("b", 2.0)], "k string, v double")
    assert {r["k"]: r["upper_median"] for r in audit.upper_median(rows, ["k"], "v").collect()} == {"a": 0.0, "b": 2.0}


def test_preparation(spark):
    from sievestone.plans.prepare import prepare
    from sievestone.plans.validate import validate

    images = spark.createDataFrame([(1, "train", "a", 0), (2, "test", "a", 0), (3, "train", "b", 1), (4, "valid", "c", 255), (5, "train", "d", 1 << 40), (6, "train", "e", 1 << 41 | 7 << 20)], "id long, split string, sha string, h long")
    lines = spark.createDataFrame([(1, 0, "0 .5 .5 .1 .1"), (2, 0, "0 .5 .5 .1 .1"), (2, 1, "9 .5 .5 .1 .1"), (3, 0, "1 .5 .5 .1 .1"), (4, 0, "2 .5 .5 .1 .1"), (6, 0, "")], "id long, line_no int, line string")
    made = prepare(images, lines, {0: "Safety_Vest", 1: "gloves", 2: "truck"}, 2)
    assert {(r["id"], r["split"]): r["text"] for r in made.files.collect()} == {(2, "test"): "3 0.500000 0.500000 0.100000 0.100000\n", (4, "val"): "", (6, "train"): ""}
    found = {(r["type"], r["source"], r["kept"], r["distance"], r["count"]) for r in made.manifest.collect()}
    assert found == {("exact_duplicate", "1", "2", None, None), ("near_duplicate", "3", "2", 1, None), ("invalid_label_lines_skipped", "2", None, None, 1), ("missing_label", "5", None, None, None)}
    good = spark.createDataFrame([(1, 0, "0 .5 .5 .1 .1")], "id long, line_no int, line string")
    one = spark.createDataFrame([(1, "train", "p", 0)], "id long, split string, path string, h long")
    near = spark.createDataFrame([(1, "train", "p", 0), (2, "val", "q", 1)], "id long, split string, path string, h long")
    both = good.unionByName(good.withColumn("id", F.lit(2)))
    text = lambda t: spark.createDataFrame([("f", t)], "name string, text string")
    assert validate(one, good, [0], 2, text("fine")).first()["status"] == "PASS"
    assert validate(one, good, [0], 2, text("password")).first()["status"] == "FAIL"
    assert validate(near, both, [0], 0, text("fine")).first()["status"] == "PASS"
    assert validate(near, both, [0], 2, text("fine")).first()["status"] == "FAIL"


def test_pairs_are_counted_by_hash(spark):
    """Against all pairs on a small table, and on a hash that 100,000 rows share."""
    rng = random.Random(4)
    rows = [(k, rng.choice([0, 1, 3, 7, 255, 1 << 63 - 1, None]), rng.choice(["train", "val", None])) for k in range(120)]
    table = spark.createDataFrame([(i, h, s) for i, h, s in rows], "id long, h long, split string")
    want = {}
    for i, (a, ha, sa) in enumerate(rows):
        for b, hb, sb in rows[:i]:
            if None not in (ha, hb, sa, sb) and (ha ^ hb).bit_count() <= 3:
                key = min(sa, sb), max(sa, sb), (ha ^ hb).bit_count()
                want[key] = want.get(key, 0) + 1
    made = splitting.split_pair_counts(table, 3).collect()
    assert {(r["first_split"], r["second_split"], r["d"]): r["pairs"] for r in made} == want
    within = hamming.distance_histogram(table.where("split IS NOT NULL"), 3, "split").collect()
    assert {(r["split"], r["split"], r["d"]): r["pairs"] for r in within} == {k: n for k, n in want.items() if k[0] == k[1]}
    pairs = hamming.hamming_pairs(table.select("id", "h"), 3).orderBy("a", "b").limit(7).collect()
    assert hamming.first_pairs(table, 3, 7).orderBy("a", "b").collect() == pairs
    hot = spark.range(100_000).selectExpr("id", "IF(id < 3, id, 7L) AS h", "IF(id % 2 = 0, 'a', 'b') AS split")
    counts = {(r["d"], r["crossing"]): r["pairs"] for r in splitting.crossing_histogram(hot, 1).collect()}
    n = 99_997
    assert counts[0, True] + counts[0, False] == n * (n - 1) // 2
    assert hamming.first_pairs(hot, 0, 10, "split").count() == 20


def test_series_and_medians_over_partitions(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice("ab"), rng.randint(0, 4000), rng.getrandbits(8)) for k in range(3000)]
    table = spark.createDataFrame(rows, "id long, prefix string, number long, h long").repartition(9)
    want = set()
    for p in "ab":
        own = sorted((n, i, h) for i, q, n, h in rows if q == p)
        want |= {(a[1], b[1], (a[2] ^ b[2]).bit_count()) for a, b in zip(own, own[1:]) if b[0] - a[0] <= 2 and (a[2] ^ b[2]).bit_count() <= 5}
    assert {tuple(r) for r in splitting.series_links(table, 2, 5).collect()} == want
    made = {r["prefix"]: r for r in audit.statistics(table, ["prefix"], "number").collect()}
    for p in "ab":
        own = sorted(n for _, q, n, _ in rows if q == p)
        assert made[p]["median"] == (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2 and made[p]["max"] == own[-1]


def test_saved_tables_are_dropped_and_clusters_need_a_folder(spark):
    import os

    from sievestone.sources import scratch

    saved = scratch.save(spark.range(3), "test")
    at = saved.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(at)
    scratch.drop(saved)
    assert not os.path.exists(at)

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Cluster.conf)})()

    with pytest.raises(ValueError, match="share"):
        scratch.shared_folder(Cluster)


@pytest.mark.parametrize("lookup", [0, 10**9])
def test_index_and_blocks_equal_brute_force(spark, monkeypatch, lookup):
    """Both ways to compare hashes, over several blocks, with copies and rows without a hash."""
    from sievestone.operators import blocks

    monkeypatch.setattr(hamming, "PAIRS_A_LOOKUP", lookup)
    monkeypatch.setattr(blocks, "SMALL", 30)
    values, _ = hash_rows(spark, 130, seed=11)
    values += [(1000 + k, values[k][1], "test") for k in range(9)] + [(2000, None, "val")]
    rows = spark.createDataFrame([(f"i{i:05}", h, s) for i, h, s in values], "id string, h long, split string")
    t, rank, name = 14, {"train": 1, "val": 2, "test": 3}, {i: f"i{i:05}" for i, _, _ in values}
    near = sorted((name[a], name[b], distance(x, y), r, s) for a, x, r in values for b, y, s in values if None not in (x, y) and a < b and distance(x, y) <= t)
    assert sorted(tuple(r) for r in hamming.hamming_pairs(rows, t).collect()) == [p[:3] for p in near]
    count = lambda keys: {k: sum(x == k for x in keys) for k in set(keys)}
    assert {tuple(r)[:2]: r["pairs"] for r in hamming.distance_histogram(rows, t, "split").collect()} == count([(r, d) for _, _, d, r, s in near if r == s])
    assert {tuple(r)[:3]: r["pairs"] for r in splitting.split_pair_counts(rows, t).collect()} == count([(min(r, s), max(r, s), d) for _, _, d, r, s in near])
    sides = rows.where("split = 'train'"), rows.where("split <> 'train'")
    made = {r["threshold"]: r["pairs"] for r in hamming.overlap_counts(*sides, (3, t)).collect()}
    assert made == {x: sum(d <= x and (r == "train") != (s == "train") for _, _, d, r, s in near) for x in (3, t)}
    assert {tuple(r) for r in hamming.hamming_join(*sides, t).collect()} == {(a, b, d) if r == "train" else (b, a, d) for a, b, d, r, s in near if (r == "train") != (s == "train")}
    firsts = {s: [(a, b, d) for a, b, d, r, u in near if r == u == s][:5] for s in rank}
    assert sorted(tuple(r) for r in hamming.first_pairs(rows, t, 5, "split").collect()) == sorted((s, *p) for s in rank for p in firsts[s])
    kept = {}
    for a, b, d, r, s in near:
        for one, two, p, q in ((a, b, r, s), (b, a, s, r)):
            if rank[p] < rank[q]:
                kept[one] = min(kept.get(one, (two, d)), (two, d))
    assert {r["removed"]: (r["kept"], r["distance"]) for r in quarantine.near_quarantine(rows, t).collect()} == kept
    groups = {x: {x} for x in name.values()}
    for a, b, *_ in near:
        if groups[a] is not groups[b]:
            groups[a] |= groups[b]
            groups.update(dict.fromkeys(groups[b], groups[a]))
    made = graph.grouped(rows, hamming.copy_edges(rows, t), "id").collect()
    assert {r["id"]: r["group_id"] for r in made} == {x: min(g) for x, g in groups.items()}


def test_wide_thresholds_look_nothing_up(spark):
    """At 30 bits a third of all pairs are near: their counts and their groups are folded block by block, without an exploded row or a link for each pair."""
    rows = spark.range(3000).select("id", F.xxhash64("id").alias("h"), F.lit("a").alias("split"))
    assert hamming.copy_edges(rows, 30).count() < 30_000
    for made in (hamming.distance_histogram(rows, 30), splitting.split_pair_counts(rows, 30), hamming.overlap_counts(rows, rows, (30,)), hamming.hamming_pairs(rows, 30)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Generate" not in plan


def crowded(spark, n_workers, n_items, seed=8):
    """Two frames of workers and items on a coarse grid, with boxes that many share, and nulls."""
    rng = random.Random(seed)
    kind = "struct<x1: double, y1: double, x2: double, y2: double>"

    def box(w, h):
        x, y = 10.0 * rng.randrange(12), 10.0 * rng.randrange(6)
        return (x, y, x + w, y + h)

    workers = [(k % 2, k if k % 9 else -k, k, box(40, 100)) for k in range(n_workers)]
    items = [(k % 2, k, rng.choice(["helmet", "gloves", "goggles", "vest", "boots", None]), box(10, 10), rng.choice([0.5, 0.9, 1.5, None])) for k in range(n_items)]
    return spark.createDataFrame(workers, f"frame_no long, track_id long, pos long, box {kind}"), spark.createDataFrame(items, f"frame_no long, item long, cls string, box {kind}, conf double")


def test_crowds_equal_all_pairs(spark):
    """Each box is compared once, however many have it; the results are those of all pairs of rows."""
    from sievestone.streaming import frames

    workers, items = crowded(spark, 300, 250)
    w, i = workers.select("frame_no", "track_id", "pos", F.col("box").alias("w")), items.withColumnRenamed("box", "i")
    pairs = i.join(w, "frame_no").withColumn("score", S.association_score(F.col("w"), F.col("i"), F.col("cls"), F.col("conf"))).where("cls <> 'boots'")
    best = {}
    for r in pairs.collect():
        key, value = (r["frame_no"], r["item"], r["cls"]), (r["score"], -r["pos"], r["track_id"])
        best[key] = max(best.get(key, value), value)
    want = {(*k, v[2], v[0]) for k, v in best.items() if v[0] >= compliance.LEAST_SCORE}
    assigned = compliance.assign_items(workers, items)
    assert {tuple(r) for r in assigned.collect()} == want
    status = {(r["frame_no"], r["track_id"], tuple(r["missing"])) for r in compliance.status(workers, assigned).collect()}
    lists = workers.groupBy("frame_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "track_id", "box"))), lambda x: F.struct(x["track_id"].alias("track_id"), x["box"].alias("box"))).alias("workers"))
    rows = lists.join(items.groupBy("frame_no").agg(F.collect_list(F.struct("cls", "box", "conf")).alias("items")), "frame_no")
    made = frames.frame_statuses(rows).collect()
    assert len(made) == 300 and {(r["frame"], r["track_id"], tuple(r["missing"])) for r in made} == status
    heads = items.where("cls = 'helmet'").withColumnRenamed("item", "idx")
    over = lambda r: max(min(r["w"]["x2"], r["i"]["x2"]) - max(r["w"]["x1"], r["i"]["x1"]), 0) * max(min(r["w"]["y2"], r["i"]["y2"]) - max(r["w"]["y1"], r["i"]["y1"]), 0)
    share, held = {}, set()
    for r in pairs.where("cls IN ('helmet', 'vest')").collect():
        if r["cls"] == "vest" and over(r) / (4100 - over(r)) >= 0.01:
            held.add((r["frame_no"], r["track_id"]))
        if r["cls"] == "helmet" and over(r) >= 50:
            value = (over(r), -r["track_id"])
            share[r["frame_no"], r["item"]] = max(share.get((r["frame_no"], r["item"]), value), value)
    assert {tuple(r) for r in compliance.assign_heads(workers, heads, 0.5).collect()} == {(*k, -v[1]) for k, v in share.items()}
    bare = compliance.uncovered(workers, items.where("cls = 'vest'"), 0.01).select("frame_no", "track_id").collect()
    assert {tuple(r) for r in bare} == {(r["frame_no"], r["track_id"]) for r in workers.collect()} - held


def test_many_workers_of_one_box_in_a_frame(spark):
    """20,000 workers and as many items of one frame: all pairs would be 400 million."""
    from sievestone.streaming import frames

    workers, items = crowded(spark, 40_000, 0)
    items = spark.range(40_000).selectExpr("id % 2 AS frame_no", "id AS item", "'vest' AS cls", "named_struct('x1', id % 100 * 1.0D, 'y1', 40.0D, 'x2', id % 100 + 10.0D, 'y2', 50.0D) AS box", "0.5D AS conf")
    assert compliance.assign_items(workers, items).count() == 40_000
    plan = compliance.assign_items(workers, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("max_by") < plan.index("Join") < plan.rindex("max_by")  # boxes are made one before they meet items
    rows = workers.groupBy("frame_no").agg(F.collect_list(F.struct("track_id", "box")).alias("workers")).join(items.groupBy("frame_no").agg(F.collect_list(F.struct("cls", "box", "conf")).alias("items")), "frame_no")
    assert frames.frame_statuses(rows).count() == 40_000


def test_matches_of_an_image_over_many_batches(spark):
    """Candidates of one image fill several Arrow batches; what an earlier one took stays taken. Python sees whole batches, not rows."""
    rng = random.Random(9)
    box = lambda: (x := rng.random() / 20, y := rng.random() / 20, x + 1, y + 1)
    schema = "image string, idx int, cls int, box struct<x1: double, y1: double, x2: double, y2: double>"
    P, G = (spark.createDataFrame([(f"i{k % 17 // 16}", k, 0, box()) for k in range(n)], schema) for n in (170, 190))
    pairs = sorted((-r["iou"], r["pred"], r["gt"], r["image"]) for r in evaluate.candidates(P, G).collect())
    taken, expected = set(), set()
    for _, p, g, image in pairs:
        if not {("p", p), ("g", g)} & taken:
            taken |= {("p", p), ("g", g)}
            expected.add((image, p, g))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 700)
    try:
        assert {(r["image"], r["pred"], r["gt"]) for r in evaluate.greedy_matches(P, G).collect()} == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines_are_taken_apart_once(spark):
    rows = spark.createDataFrame([("s", k, x) for k, x in enumerate(["\t0 .5\u000b.5  .2 .2\r", " \t", None, "0 1e3 .5 .2 x", "99999999999 .5 .5 .2 .2"])], "stem string, line_no int, line string")
    made = labels.validate(rows, "audit", [0])
    assert [(r["line_no"], r["errors"], r["cls"], r["is_box"]) for r in made.orderBy("line_no").collect()] == [(0, [], 0, True), (3, ["non_numeric"], 0, False), (4, [], None, True)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "regexp_replace" not in plan
