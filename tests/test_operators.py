"""Operators against brute force on small inputs, with the skew paths forced on."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparktidy.operators import columns, dedup, enrich, linking, quality, skew, summarize, survivorship


@pytest.fixture(params=[False, True], ids=["plain", "heavy keys"])
def heavy(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(skew, "HEAVY_ROWS", 2)
        monkeypatch.setattr(skew, "HEAVY_KEYS", 3)
    return request.param


def partition_of(rows, key_sets):
    """Brute-force grouping: repeat merging until nothing changes."""
    label = {r["row_id"]: r["row_id"] for r in rows}
    changed = True
    while changed:
        changed = False
        for keys in key_sets:
            seen = {}
            for r in rows:
                key = tuple(r[k] for k in keys)
                if None in key:
                    continue
                seen.setdefault(key, []).append(r["row_id"])
            for members in seen.values():
                low = min(label[m] for m in members)
                for m in members:
                    changed |= label[m] != low
                    label[m] = low
    return label


KEYS = [["email"], ["name", "phone"]]
SCHEMA = "row_id long, email string, name string, phone string"


def linked_labels(spark, rows):
    df = spark.createDataFrame([(r["row_id"], r["email"], r["name"], r["phone"]) for r in rows], SCHEMA)
    out = linking.link_records(df, KEYS, "row_id").collect()
    sizes = {r.group_id: r.group_size for r in out}
    for group, size in sizes.items():
        assert size == sum(r.group_id == group for r in out)
    return {r.row_id: r.group_id for r in out}


def test_linking_is_transitive_and_ignores_missing_keys(spark):
    rows = [dict(zip(("row_id", "email", "name", "phone"), r)) for r in [
        (0, "a@x.pl", "jan", "111"), (1, "a@x.pl", "jan", "222"), (2, None, "jan", "222"), (3, None, "ewa", None), (4, None, "ewa", None)]]
    assert linked_labels(spark, rows) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}


def test_linking_matches_brute_force(spark, heavy):
    rng = random.Random(5)
    rows = [{"row_id": i * 8 % 301, "email": rng.choice([None, f"e{rng.randint(0, 120)}"]), "name": f"n{rng.randint(0, 3)}",
             "phone": rng.choice([None, f"p{rng.randint(0, 60)}"])} for i in range(301)]
    expected = partition_of(rows, KEYS)
    assert linked_labels(spark, rows) == expected
    assert linked_labels(spark, rows[::-1]) == expected


def test_a_long_chain_settles(spark):
    n = 200
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    # row i shares its e-mail with one neighbour and name and phone with the other
    rows = [{"row_id": ids[i], "email": f"e{i // 2}", "name": "x", "phone": f"p{(i + 1) // 2}"} for i in range(n)]
    assert set(linked_labels(spark, rows).values()) == {0}


def test_a_hot_key_and_oversized_groups(spark, heavy):
    rows = [{"row_id": i, "email": "office@x.pl" if i % 3 else None, "name": "n", "phone": str(i)} for i in range(90)]
    assert linked_labels(spark, rows) == partition_of(rows, KEYS)
    df = spark.createDataFrame([(r["row_id"], r["email"], r["name"], r["phone"]) for r in rows], SCHEMA)
    big = linking.oversized_groups(linking.link_records(df, KEYS, "row_id"), 10).collect()
    assert [(r.group_id, r.group_size) for r in big] == [(1, 60)]


def test_components_match_brute_force(spark, heavy):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 640)] + [(700, i) for i in range(701, 790)]
    group = {n: n for e in edges for n in e}

    def top(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in edges:
        group[max(top(a), top(b))] = min(top(a), top(b))
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "child bigint, parent bigint")
    got = sorted(map(tuple, linking.connected_stars(df).collect()))
    assert got == sorted((n, top(n)) for n in group if n != top(n))


def test_a_round_of_linking_is_one_shuffle_an_end(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(linking, "contracted", lambda e, j, real=linking.contracted: rounds.append((e, j)) or real(e, j))
    chain = spark.range(1, 2000).selectExpr("id as child", "id - 1 as parent")
    assert linking.connected_stars(chain).filter("parent = 0").count() == 1999
    assert len(rounds) <= 20  # a path of 2000 nodes
    edges, joins = spark.range(5).selectExpr("id + 1 as child", "id as parent"), spark.range(5).selectExpr("id as node", "id - 1 as into", "1L as n")

    def hashed(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert hashed(linking.joined_nodes(edges, 0)) == 1
    # two sides for each end, and the distinct edges
    assert hashed(linking.contracted(edges, joins)) <= 5


def test_linking_nothing(spark):
    df = spark.createDataFrame([(1, None, "a", None), (2, "x", "b", None)], SCHEMA)
    assert sorted(map(tuple, linking.link_records(df, KEYS, "row_id").select("row_id", "group_id", "group_size").collect())) == [(1, 1, 1), (2, 2, 1)]


def test_keep_first_matches_brute_force(spark, heavy):
    rng = random.Random(3)
    rows = [(i, rng.choice("AB"), rng.choice([None, "d1", "d2"]), rng.choice([None, "s1"])) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, branch string, doc string, sku string").repartition(5)
    kept, removed = dedup.dedup_keep_first(df, ["branch", "doc", "sku"], "row_id", "doc")
    seen, expected = set(), set()
    for r in rows:
        if r[2] is None or r[1:] not in seen:
            expected.add(r[0])
        seen.add(r[1:])
    assert {r.row_id for r in kept.collect()} == expected
    assert {r.row_id for r in removed.collect()} == {r[0] for r in rows} - expected


def test_keep_first_joins_eligible_rows_only(spark):
    wide = "concat(repeat('x', 10000), case when id % 2 = 0 then 'hot' else cast(id as string) end)"
    df = spark.range(400).selectExpr("id as row_id", f"{wide} as doc", "id % 4 = 3 as missing").selectExpr("row_id", "case when not missing then doc end as doc")
    kept, removed = dedup.dedup_keep_first(df, ["doc"], "row_id", "doc")
    assert sorted(r.row_id for r in kept.select("row_id").collect()) == sorted([0, *range(1, 400, 2)])
    assert removed.count() == 199
    plan = kept._jdf.queryExecution().executedPlan().toString()
    union = plan[plan.index("Union") :]
    # the branch of rows without a key is a plain filter
    last = union.split("Range (0, 400")[-2]
    assert "Exchange" not in last.split("+- *(")[-1] and "Join" not in last.split("+- *(")[-1]
    # wide keys are neither shuffled nor broadcast as keys
    assert "hashpartitioning(doc" not in plan


def test_exact_dedup_keeps_the_first_id(spark):
    df = spark.createDataFrame([(3, None, "a"), (1, None, "a"), (2, "x", "a"), (4, None, "a")], "row_id long, p string, q string")
    assert sorted(map(tuple, dedup.dedup_exact(df, "row_id").select("row_id", "copies").collect())) == [(1, 3), (2, 1)]
    assert dedup.dedup_exact(df.drop("row_id")).count() == 2


@pytest.mark.parametrize("limit", [1 << 20, 0], ids=["broadcast", "shuffle"])
def test_lookup_matches_null_with_null(spark, heavy, limit):
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "b", None, "a", "z", None, "a"])], "row_id long, k string")
    dimension = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("unused", 9)], "k string, v int")
    out = enrich.enrich(facts, dimension, "k", "row_id", max_broadcast_bytes=limit).orderBy("row_id").collect()
    assert [(r.k, r.v, r.matched) for r in out] == [
        ("a", 1, True), ("b", None, True), (None, 2, True), ("a", 1, True), ("z", None, False), (None, 2, True), ("a", 1, True)]
    left = enrich.unmatched_keys(facts, dimension, "k").collect()
    assert [r.k for r in left] == ["z"]


def test_repeated_dimension_keys_are_named(spark):
    dimension = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 2), ("b", 1)], "k string, v int")
    with pytest.raises(enrich.RepeatedKeysError, match=r"\[None, 'a'\]"):
        enrich.enrich(spark.range(1).selectExpr("id as row_id", "'a' as k"), dimension, "k", "row_id")


def test_small_dimension_is_broadcast_and_facts_stay(spark):
    facts = spark.range(1000).selectExpr("id as row_id", "concat('k', id % 7) as k")
    dimension = spark.range(7).selectExpr("concat('k', id) as k", "id as v")
    plan = enrich.enrich(facts, dimension, "k", "row_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning(k" not in plan.split("BroadcastExchange")[0]


def test_golden_record_and_id_lists(spark):
    rows = [
        (1, 1, "K3", None, "2024-02-01", 1.5), (2, 1, "K1", "b", None, None), (3, 1, "K2", "c", "2024-01-01", 2.0),
        (4, 4, "K9", None, None, None), (5, 5, None, "x", None, 1.0), (6, 5, "K5", "y", None, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, group_id long, id string, v string, d string, amount double").withColumn("d", F.col("d").cast("date"))
    sizes = df.groupBy("group_id").agg(F.count("*").alias("group_size"))
    linked = df.join(sizes, "group_id")
    golden = survivorship.golden_records(linked, ["id", "v"], "d", "row_id", {
        "d": (F.min("d"), F.col("d")), "amount": (F.sum("amount"), F.col("amount")), "n": (F.count(F.lit(1)), F.lit(1).cast("bigint")),
        "ids": (survivorship.sorted_ids("id", limit=2), F.coalesce("id", F.lit("")))})
    golden = survivorship.with_id_text(golden, linked, "id", "ids", limit=2)
    got = {r.group_id: (r.id, r.v, str(r.d), r.amount, r.n, r.ids) for r in golden.collect()}
    # v of the earliest dated row that has one; a list above the limit is filled in from its parts
    assert got == {1: ("K2", "c", "2024-01-01", 3.5, 3, "K1, K2, K3"), 4: ("K9", None, "None", None, 1, "K9"), 5: ("K5", "x", "None", 2.0, 2, "K5")}


@pytest.mark.parametrize("per_part", [3, 1000])
def test_merged_ids_in_parts(spark, per_part):
    rng = random.Random(2)
    groups = {0: 50, 50: 1, 51: 2, 53: 4, 57: 3}
    rows, expected = [], {}
    for first, size in groups.items():
        names = [f"K{rng.randint(0, 99999):05d}" for _ in range(size)]
        rows += [(first + i, first, size, n) for i, n in enumerate(names)]
        if size > 1:
            expected[first] = sorted(names)
    df = spark.createDataFrame(rows, "row_id long, group_id long, group_size long, id string").repartition(4)
    parts = survivorship.merged_ids(df, "id", per_part=per_part).orderBy("group_id", "part_no").collect()
    got = {g: ", ".join(p.record_ids for p in ps) for g, ps in itertools.groupby(parts, key=lambda p: p.group_id)}
    assert got == {g: ", ".join(names) for g, names in expected.items()}
    assert all(p.ids <= per_part and len(p.record_ids.split(", ")) == p.ids for p in parts)


def test_pivot_totals_leave_null_keys_out(spark):
    df = spark.createDataFrame([("m1", "A", 1.0), ("m1", "B", 2.0), ("m2", "A", 4.0), (None, "A", 8.0), ("m2", None, 16.0), ("m3", "A", None)], "m string, b string, v double")
    out = {r.m: (r.A, r.B, r.RAZEM) for r in summarize.pivot_with_totals(df, "m", "b", "v").collect()}
    assert out == {"m1": (1.0, 2.0, 3.0), "m2": (4.0, None, 4.0), "RAZEM": (5.0, 2.0, 7.0)}


def test_reconcile(spark):
    facts = spark.createDataFrame([("A", "1.10"), ("A", "2.20"), ("B", "5.00")], "b string, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    controls = spark.createDataFrame([("A", "3.30"), ("B", "5.01"), ("C", None)], "b string, suma_z_pliku string").withColumn("suma_z_pliku", F.col("suma_z_pliku").cast("decimal(18,2)"))
    checks = summarize.reconcile(facts, controls, "b", "v")
    assert {r.b: r.zgodne for r in checks.collect()} == {"A": "TAK", "B": "NIE", "C": "NIE"}
    assert str(summarize.total_difference(checks).first()[0]) == "0.01"
    assert str(summarize.total_difference(checks.limit(0)).first()[0]) == "0.00"


def test_sample_per_group(spark):
    rows = [(i, g, i % 3 == 0 if g == "x" else i == 7) for g, ids in {"x": range(0, 9), "y": range(20, 25), "z": [7]}.items() for i in ids]
    df = spark.createDataFrame(rows, "row_id long, g string, messy boolean").repartition(4)
    out = summarize.sample_per_group(df, "g", F.col("messy"), ["row_id"], {"x": 2, "z": 2})
    assert sorted((r.g, r.row_id) for r in out.collect()) == [("x", 0), ("x", 3), ("y", 20), ("z", 7)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_rejects_and_issues(spark):
    df = spark.createDataFrame([(1, "a", None, "raw"), (2, None, None, None), (3, "x", "y", "z")], "id long, p string, q string, q_raw string")
    good, bad = quality.split_rejects(df, ["p", "q"])
    assert [r.id for r in good.collect()] == [3]
    assert {r.id: r.reason for r in bad.collect()} == {1: "q", 2: "p, q"}
    issues = {"q": quality.field_issue("q", "q_raw", "pole")}
    assert {r.id: r.issue for r in quality.issue_rows(df, "id", issues).collect()} == {1: "nieprawidłowy pole: 'raw'", 2: "brak: pole"}


def test_postal_mismatch(spark):
    df = spark.createDataFrame([("Warszawa", "00-950"), ("Warszawa", "30-001"), ("Kraków", "31-000"), ("Zakopane", "99-999"), ("Łódź", None), (None, "00-001")], "c string, p string")
    assert [r[0] for r in df.select(quality.postal_mismatch(F.col("c"), F.col("p"))).collect()] == [False, True, False, False, False, False]


def test_header_mapping(spark):
    df = spark.createDataFrame([("a", "b", "c")], "` E-MAIL ` string, `Kod poczt.` string, other string")
    out = columns.standardize_columns(df, {"kod_pocztowy": ["kod poczt."], "email": ["e-mail"]})
    assert out.columns == ["kod_pocztowy", "email"] and tuple(out.first()) == ("b", "a")
    with pytest.raises(columns.MissingColumnsError, match="telefon"):
        columns.standardize_columns(df, {"telefon": ["tel."]})
    with pytest.raises(KeyError):
        columns.standardize_columns(df, {"telefon": ["tel."]})
    with pytest.raises(columns.AmbiguousColumnsError):
        columns.standardize_columns(df, {"email": ["e-mail", "other"]})


def test_optional_column_and_text_view(spark):
    df = spark.createDataFrame([(667063296.0, 1)], "`Nr paragonu` double, n int")
    assert columns.with_optional_column(df, "nr_transakcji", ["nr paragonu"]).columns == df.columns
    assert columns.with_optional_column(df, "nr_transakcji", ["id"]).columns[-1] == "nr_transakcji"
    assert tuple(columns.as_text(df).first()) == ("667063296", "1")


def test_blank_rows(spark):
    df = spark.createDataFrame([("", None), (" - ", "BRAK"), ("x", None), (" \t", "n/a")], "a string, b string")
    assert [r.a for r in columns.drop_blank_rows(df).collect()] == ["x"]


def test_change_log_is_one_aggregate(spark):
    df = spark.createDataFrame([("a", "A"), (None, None), ("b", "b")], "x string, y string")
    log = quality.change_log(df, [quality.Step("all", "rows", F.count(F.lit(1))), quality.Step("changed", "standardized", quality.count_changed(F.col("x"), F.col("y"))),
                                  quality.Step("none", "removed", F.sum(F.lit(None).cast("int")))])
    assert [tuple(r) for r in log.collect()] == [(1, "all", "rows", 3), (2, "changed", "standardized", 1), (3, "none", "removed", 0)]


def test_messiest_rows(spark):
    df = spark.createDataFrame([(1, " a ", "b"), (2, "a", "brak"), (3, " a", " b"), (4, None, "x")], "row_id long, p string, q string")
    out = quality.messiest_rows(df, ["p", "q"], "row_id", n=3).collect()
    assert [(r.row_id, r.score) for r in out] == [(3, 2), (1, 1), (2, 1)]


def test_repeats_by_broadcast_and_by_shuffle(spark, monkeypatch):
    """Both ways give the same flags, null keys too; few repeated keys salt and shuffle no rows."""
    from sparktidy.operators import dedup

    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"k{i % 40}", "d" if i % 5 else None) for i in range(200)], "row_id long, key string, doc string")
    want = {}
    for r in sorted(rows.collect()):
        want[r.row_id] = r.doc is not None and any(o.doc is not None and o.key == r.key and o.row_id < r.row_id for o in rows.collect())
    for keys in (dedup.BROADCAST_KEYS, 0):
        monkeypatch.setattr(dedup, "BROADCAST_KEYS", keys)
        marked = dedup.mark_repeats(rows, ["key"], "row_id", F.col("doc").isNotNull())
        assert {r.row_id: r.is_repeat for r in marked.collect()} == want
        assert ("__salt" in marked._jdf.queryExecution().optimizedPlan().toString()) == (keys == 0)


def test_rows_of_many_repeated_keys_are_not_sorted(spark, monkeypatch):
    from sparktidy.operators import dedup

    rows = spark.createDataFrame([(i, f"k{i % 40}", "x" * 20) for i in range(200)], "row_id long, key string, note string")
    want = {(i, i >= 40) for i in range(200)}
    monkeypatch.setattr(dedup, "BROADCAST_KEYS", 0)
    for size, sorts in ((100, False), (1 << 40, True)):
        monkeypatch.setattr(dedup, "KEY_BYTES", size)
        marked = dedup.mark_repeats(rows, ["key"], "row_id", F.col("key").isNotNull())
        assert {(r.row_id, r.is_repeat) for r in marked.collect()} == want
        assert ("strategy=shuffle_hash" in marked._jdf.queryExecution().optimizedPlan().toString()) != sorts


def test_large_dimension_counts_keys_of_the_cheaper_table(spark):
    facts = spark.createDataFrame([(i, None if i % 9 == 0 else f"s{i % 5}") for i in range(100)], "row_id long, sku string")
    costly = facts.withColumn("n", F.xxhash64("sku"))
    catalog = spark.createDataFrame([("s1", 1.0), ("s2", 2.0), (None, 9.0)], "sku string, price double")
    got = enrich.enrich(costly, catalog, "sku", "row_id", max_broadcast_bytes=0, counted=facts.select("sku"))
    small = enrich.enrich(costly, catalog, "sku", "row_id")
    assert sorted(got.collect()) == sorted(small.select(*got.columns).collect())


def test_large_dimension_is_hashed_and_rows_carry_no_salt(spark, monkeypatch):
    from sparktidy.operators import skew

    facts = spark.createDataFrame([(i, None if i % 9 == 0 else f"s{i % 5}") for i in range(100)], "row_id long, sku string")
    catalog = spark.createDataFrame([("s1", 1.0), ("s2", 2.0), (None, 9.0), ("s9", 3.0)], "sku string, price double")
    want = sorted(enrich.enrich(facts, catalog, "sku", "row_id").collect())

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    got = enrich.enrich(facts, catalog, "sku", "row_id", max_broadcast_bytes=0)
    assert sorted(got.collect()) == want
    assert "ShuffledHashJoin" in plan(got) and "SortMergeJoin" not in plan(got) and "__salt" not in plan(got)
    # heavy keys are answered by a broadcast and their rows spread, as before
    monkeypatch.setattr(skew, "HEAVY_ROWS", 15)
    heavy = enrich.enrich(facts, catalog, "sku", "row_id", max_broadcast_bytes=0)
    assert sorted(heavy.collect()) == want and "__salt" in plan(heavy)
    # partitions that do not fit are sorted
    monkeypatch.setattr(enrich, "HASHED_BYTES", 0)
    large = enrich.enrich(facts, catalog, "sku", "row_id", max_broadcast_bytes=0)
    assert sorted(large.collect()) == want and "ShuffledHashJoin" not in plan(large)


def test_total_rows_are_seen_before_cleaning(spark):
    from sparktidy.sources.totals import is_total_row

    cells = ["RAZEM", " razem\xa0", "\u2003Suma\t", "total", "suma 1", "2024-01-01", "", None, "TOTALA", "\x1cTotal\x1f", "-", "ra zem"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    found = rows.select("i", is_total_row(F.col("c")).alias("t"), is_total_row(F.col("c"), ["GRAND TOTAL", "razem"]).alias("own"))
    assert [r.i for r in found.orderBy("i").collect() if r.t] == [0, 1, 2, 3, 9]
    assert not any(r.own for r in found.collect())
    label = spark.createDataFrame([(" grand \t total",)], "c string").select(is_total_row(F.col("c"), ["GRAND TOTAL"])).first()[0]
    assert label is True
    # data rows are told by a search for the labels alone
    assert "Contains" in found._jdf.queryExecution().optimizedPlan().toString()
