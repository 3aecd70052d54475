"""Operators for nested records, drift, page history, hot keys and profiles, on small cases and against brute force."""

import json
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions.links import link_page_of, page_code, page_code_of
from fieldloom.operators import dedup_index, drift, hotkeys, nested, profile, smallworld


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- nested records


def test_flatten_labels_and_parents(spark):
    record = {"A": {"x/y": [None, {"k": 1}, [{"z": None}]]}, "S": json.dumps({"in": {"er": "v"}}), "L": json.dumps([{"a": 1}, 2]), "t": "[not json", "e": ""}
    df = spark.createDataFrame([(1, json.dumps(record), "clash")], "id int, j string, dewey string")
    nodes = nested.flatten(df, "id", "j")
    assert rows(nested.links(nodes, "id")) == sorted(
        [(1, "", "A"), (1, "A", "A/x/y/1"), (1, "A", "A/x/y/2/0"), (1, "", "S"), (1, "S", "S/in"), (1, "", "L/0")], key=repr
    )
    by = {r["node_path"]: r for r in nodes.withColumn("parent", nested.parent_dewey()).collect()}
    assert by["A/x/y/2/0"]["dewey"] == "0.0.2.0" and by["A/x/y/2/0"]["parent"] == "0"
    assert by["A/x/y/2/0"]["schema_path"] == "A/x~1y[][]" and by["A/x/y/1"]["fields"] == {"k": "1"}
    assert by["A/x/y/2/0"]["fields"] == {"z": None} and by[""]["fields"] == {"t": "[not json", "e": ""}


def test_flatten_odd_records(spark):
    deep = "[" * 50_000 + "]" * 50_000
    cases = [None, "", "nonsense", "3", "[]", '[{"a":{}}]', deep, "{} {}", '{"n":' + "9" * 5000 + "}", json.dumps(json.dumps({"a": {}}))]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, j string")
    nodes = nested.flatten(df, "id", "j")
    found = {}
    for r in nodes.collect():
        found.setdefault(r["id"], []).append(r)
    assert all(found[i][0]["error"] for i in (0, 1, 2, 6, 7))
    assert 3 not in found and 4 not in found
    assert {(r["node_path"]) for r in found[5]} == {"0", "0/a"} and {r["node_path"] for r in found[9]} == {"", "a"}
    assert found[8][0]["error"] is None
    assert nested.flatten(df.limit(0), "id", "j").count() == 0
    assert nested.flatten(df.union(df), "id", "j").count() == 2 * nodes.count()


def test_flat_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"D":{"N":"a","id":"q"},"E":[{"K":"k","V":{"u":1}},null,{"K":"N/A"}]}')], "id int, j string")
    nodes = nested.flatten(df, "id", "j")
    assert rows(nested.table_at(nodes, "id", "D", ["N", "id", "gone"])) == [(1, "0", "", "a", "q", None)]
    assert rows(nested.table_at(nodes, "id", "E[]", ["K"]).select("dewey", "K")) == [("1.0", "k"), ("1.2", "N/A")]
    made = nested.write_tables(nodes, "id", str(tmp_path / "t"))
    assert sorted(made) == ["", "D", "E[]", "E[]/V", "E[]:values"]
    assert sum(spark.read.parquet(p).count() for p in made.values()) == nodes.count() == 6


def test_typed_tables(spark):
    record = {"D": {"n": 1, "x": 1.5, "b": True, "code": "007", "id": "7", "ID": "q", "mix": 1, "none": None, "N": "up"}, "E": {"mix": "z"}}
    more = {"D": {"n": "12", "x": 2, "b": False, "mix": "N/A", "dewey": "clash"}}
    nodes = nested.flatten(spark.createDataFrame([(1, json.dumps(record)), (2, json.dumps(more)), (3, "broken")], "id int, j string"), "id", "j")
    made = nested.tables(nodes, "id")
    assert {c: t for c, t in made["D"].dtypes} == {
        "id": "int", "dewey": "string", "parent_dewey": "string", "ID_2": "string", "N": "string", "b": "boolean", "code": "string", "dewey_2": "string", "id_3": "bigint", "mix": "string", "n_2": "bigint", "none": "string", "x": "double",
    }
    got = {r["id"]: r for r in made["D"].collect()}
    assert (got[1]["n_2"], got[1]["x"], got[1]["b"], got[1]["code"], got[2]["dewey_2"], got[2]["mix"], got[2]["N"]) == (1, 1.5, True, "007", "clash", "N/A", None)
    assert made[""].count() == 2 and made["E"].columns == ["id", "dewey", "parent_dewey", "mix"]
    assert nested.tables(nodes.limit(0), "id") == {}


def test_scalars_in_lists_are_kept(spark, tmp_path):
    record = {"D": {"I": ["HMUB"], "M": json.dumps(["1", 2, None, {"a": 1}, [True]]), "Z": []}}
    nodes = nested.flatten(spark.createDataFrame([(1, json.dumps(record)), (2, "[7]")], "id int, j string"), "id", "j")
    want = [(1, "0.0.0", "0", "D/I[]", "HMUB"), (1, "0.1.0", "0", "D/M[]", "1"), (1, "0.1.1", "0", "D/M[]", "2"), (1, "0.1.2", "0", "D/M[]", None), (1, "0.1.4.0", "0", "D/M[][]", "true"), (2, "0", "", "[]", "7")]
    assert rows(nested.list_values(nodes, "id")) == sorted(want, key=repr)
    assert rows(nested.links(nodes, "id")) == [(1, "", "D"), (1, "D", "D/M/3")] and nested.table_at(nodes, "id", "D/M[]", ["a"]).count() == 1
    made = nested.write_tables(nodes, "id", str(tmp_path / "t"))
    got = {(p.removesuffix(":values"), r["value"]) for p, path in made.items() if p.endswith(":values") for r in spark.read.parquet(path).collect()}
    assert got == {(w[3], w[4]) for w in want}


def test_parents_of_each_table(spark, tmp_path):
    from fieldloom.plans import problems

    data = [(1, '{"G":[{"E":[{},{}]},{"E":[{}]}]}'), (2, '{"G":[{"E":[{}]},{"E":[]}]}')]
    spark.createDataFrame(data, "item_id bigint, raw_json string").write.parquet(str(tmp_path / "airport_items.parquet"))
    assert rows(problems.p1_parents(spark, str(tmp_path))) == [("", 2, 2, 0), ("G[]", 4, 2, 2), ("G[]/E[]", 4, 2, 3)]


def test_all_objects_with_all_fields(spark, tmp_path):
    from fieldloom.plans import problems

    more = {"Customs": "Yes", "Fuel": {"Min": 1}}
    listed = [None, {"Group": "g", "Entries": [{"Key": "k", "Value": "v", "Remarks": "r"}, {"Key": "q", "Value": {"u": None}}]}]
    data = [(1, json.dumps({"id": 7, "Airport Details": json.dumps({"FIR": "x", "Nation": ""}), "Additional Airport Details": more})), (2, json.dumps({"Additional Airport Details": listed})), (3, "no json")]
    spark.createDataFrame(data, "item_id bigint, raw_json string").write.parquet(str(tmp_path / "airport_items.parquet"))
    a = "Additional Airport Details"
    want = [(1, "", "", "", {"id": "7"}), (1, "1", "", "Airport Details", {"FIR": "x", "Nation": ""}), (1, "2", "", a, {"Customs": "Yes"}), (1, "2.1", "2", a + "/Fuel", {"Min": "1"}), (2, "", "", "", {})]
    want += [(2, "0.1", "", a + "[]", {"Group": "g"}), (2, "0.1.1.0", "0.1", a + "[]/Entries[]", {"Key": "k", "Value": "v", "Remarks": "r"})]
    want += [(2, "0.1.1.1", "0.1", a + "[]/Entries[]", {"Key": "q"}), (2, "0.1.1.1.1", "0.1.1.1", a + "[]/Entries[]/Value", {"u": None})]
    assert rows(problems.p1_objects(spark, str(tmp_path))) == sorted(want, key=repr)


# ---- drift


def feeds(spark, *loads):
    items, n = [], 0
    for f, records in enumerate(loads, 1):
        for r in records:
            n += 1
            items.append((n, f, r if r is None or isinstance(r, str) else json.dumps(r)))
    files = [(f, "s", f) for f in range(1, len(loads) + 1)]
    return spark.createDataFrame(items, "item_id bigint, feed_id bigint, raw_json string"), spark.createDataFrame(files, "feed_id bigint, series string, load_no int")


def report(spark, items, files, *match):
    held = drift.held_fields(items, "feed_id", "raw_json")
    sizes = items.groupBy(F.col("feed_id").alias("feed")).agg(F.count(F.lit(1)).alias("records"))
    pairs = drift.consecutive(files, "feed_id", "series", "load_no")
    fields = drift.existing(held, sizes)
    return drift.changes(held, fields, pairs, *match), pairs, fields


def code(i):
    return f"{i:05d}"[::-1] + f"{i * 7 % 99991:05d}"


def airport(i, details, more):
    return {"Airport Details": {"Link": f"https://h.example/Field-Info/x-{code(i)}", **details}, "Additional Airport Details": more}


def test_changes_of_every_kind(spark):
    old = [airport(i, {"City": f"c{i}"}, {"Customs": ["Yes", "No"][i % 2], "Gone": f"g{i}", "Hours": f"h{i}"}) for i in range(20)]
    new = []
    for i in range(20):
        a = airport(i, {"Municipality": f"c{i}"}, [{"Group": "g", "Entries": [{"Key": "Customs", "Value": i % 2 == 0}, None, {"Key": "Op Hours", "Value": f"h{i}"}, {"Key": "New", "Value": {"a": i}}]}])
        a["Airport Details"]["Url"] = a["Airport Details"].pop("Link") + "?utm=1"
        new.append(a)
    new += [None, "no json"]
    items, files = feeds(spark, old, new)
    found, pairs, fields = report(spark, items, files)
    d, m = drift.SECTIONS
    assert rows(found) == sorted(
        [(2, d, "renamed", "City", "Municipality"), (2, d, "renamed", "Link", "Url"), (2, m, "renamed", "Hours", "Op Hours"), (2, m, "retyped", "Customs", "Customs"), (2, m, "removed", "Gone", ""), (2, m, "added", "", "New")], key=repr
    )
    names = drift.canonical_names(found, pairs, files, "feed_id", "series", "load_no")
    assert {(r["field"], r["name"]) for r in names.collect()} == {("Municipality", "City"), ("Url", "Link"), ("Op Hours", "Hours")}
    columns = drift.targets(fields, names)
    table = drift.unified(items, "item_id", "feed_id", "raw_json", names, columns)
    assert table.count() == items.count() and table.where("additional_hours is not null").count() == 40
    assert {t.column: t.type for t in columns} == {
        "details_city": "string", "details_link": "string", "additional_customs": "boolean", "additional_gone": "string", "additional_hours": "string", "additional_new": "object",
    }
    assert table.where("size(other) > 0").count() == 0 and table.where("details_city = concat('c', (item_id - 1) % 20)").count() == 40
    assert dict(table.schema["additional_customs"].jsonValue())["type"] == "boolean" and table.where("additional_customs").count() == 20


def test_unified_keeps_what_does_not_fit(spark):
    old = [airport(i, {"N": i}, {"L": [i]}) for i in range(8)]
    new = [airport(i, {"N": str(i) if i else "many", "n": "z"}, {"L": i, "Rare": None if i else {"a": 1}}) for i in range(8)] + [None, "[]", '"x"', "no json"]
    items, files = feeds(spark, old, new)
    found, pairs, fields = report(spark, items, files)
    names = drift.canonical_names(found, pairs, files, "feed_id", "series", "load_no")
    clash = items.withColumn("other", F.lit(1)).withColumn("renames", F.lit(2))
    table = drift.unified(clash, "item_id", "feed_id", "raw_json", names, drift.targets(fields, names))
    got = {r["item_id"]: r for r in table.collect()}
    assert len(got) == 20 and {type(r["details_n"]) for r in got.values()} == {float, type(None)}
    assert got[9]["details_n"] is None and got[9]["other"] == {"Airport Details/N": '"many"', "Additional Airport Details/Rare": '{"a": 1}'}
    assert got[10]["details_n"] == 1 and got[10]["additional_l"] == "[1]" and got[10]["details_n_2"] == "z"
    assert all(got[i]["other"] == {} and got[i]["details_link"] is None for i in (17, 18, 19, 20))
    assert drift.unified(items.limit(0), "item_id", "feed_id", "raw_json", names, []).count() == 0


def test_flooding_decides_which_fields_are_compared(spark):
    """Two fields come with the same content as one that goes: flooding tells which it is. Scores turned round tell otherwise."""

    def turned(old, new):
        return 1 - drift.flood(old, new)

    old = [airport(i, {"City": "c"}, {"Tower Hours": f"h{i}", "Fuel": {"Min": 1}}) for i in range(20)]
    new = [airport(i, {"City": "c"}, {"Control Tower Hours": f"h{i}", "Zz Note": f"h{i}", "Fuel": {"Min": 1}}) for i in range(20)]
    items, files = feeds(spark, old, new)
    m = drift.SECTIONS[1]
    assert rows(report(spark, items, files)[0]) == sorted([(2, m, "renamed", "Tower Hours", "Control Tower Hours"), (2, m, "added", "", "Zz Note")], key=repr)
    assert (2, m, "renamed", "Tower Hours", "Control Tower Hours") not in rows(report(spark, items, files, turned)[0])


def test_pairs_beyond_the_candidates_are_compared_where_these_fail(spark):
    """Four fields change their names crosswise, so that the best matches by name are the wrong ones."""
    went = ["Alpha One", "Alpha Two", "Alpha Three", "Alpha Four"]
    came = ["Alpha Two A", "Alpha Three A", "Alpha Four A", "Alpha One A"]
    for turn in range(4):
        now = came[turn:] + came[:turn]
        old = [airport(i, {}, {n: f"{k}-{i}" for k, n in enumerate(went)}) for i in range(12)]
        new = [airport(i, {}, {n: f"{k}-{i}" for k, n in enumerate(now)}) for i in range(12)]
        assert rows(report(spark, *feeds(spark, old, new))[0]) == sorted([(2, drift.SECTIONS[1], "renamed", a, b) for a, b in zip(went, now)], key=repr)


def test_no_shared_page_is_no_rename_and_few_holders_no_field(spark):
    items, files = feeds(spark, [airport(i, {"City": "c"}, {}) for i in range(10)], [airport(i, {"Town": "c"}, {"Rare": "r"} if i == 50 else {}) for i in range(50, 60)])
    assert {r["kind"] for r in report(spark, items, files)[0].collect()} == {"added", "removed"}
    assert report(spark, items.limit(0), files)[0].count() == 0


def test_flooding_prefers_like_names_and_types():
    old = [("S", "Airport Hours", "string", ""), ("S", "Fuel", "object", "Min,Unit"), ("S", "Same", "string", "")]
    new = [("S", "airport_hours", "string", ""), ("S", "Uplift", "object", "Min,Unit"), ("S", "Same", "string", "")]
    s = drift.flood(old, new)
    assert s.argmax(1).tolist() == [0, 1, 2] and s.max() == pytest.approx(1)


# ---- page history


def test_page_codes(spark):
    links = {
        "https://h/Field-Info/a-b-TRUD-d7xpm2arvx?utm=1\xa0": "d7xpm2arvx",
        "../Field-Info/m-DUKS-hysfb5narj/index.html": "hysfb5narj",
        "https://h/Field-Info/n-Y%61kzqqptnx": "yakzqqptnx",
        "https://h/x-9b68vu9q6e.html​": "9b68vu9q6e",
        "/Field-Info/a-RBURYBJQK2//?from=%2Fq-aaaaaaaaaa#x": "rburybjqk2",
        "/Field-Info/d7xpm2arvx": "d7xpm2arvx",
        "https://h/contacts/": None, " ": None, "N/A": None, "%zz-1234567890": "1234567890",
        "https://h/Field-Info/a%7%32k-uvgvsg%758kd": "uvgvsgu8kd",
    }
    df = spark.createDataFrame([(k,) for k in links], "l string").select("l", page_code(F.col("l")).alias("c"))
    assert {r["l"]: r["c"] for r in df.collect()} == links
    assert {k: page_code_of(k) for k in links} == links
    assert link_page_of("X - A/B-Brenprburg/x y") is None and link_page_of(3) is None


def make_codes(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices("23456789abcdefghjkmnpqrstuvwxyz", k=10)) for _ in range(n)]


def brute(ids):
    """ids: {id: code} -> {(first, later)}"""
    out, pages = set(), []
    for i in sorted(ids):
        c = ids[i]
        hit = [f for f, p in pages if sum(a != b for a, b in zip(p, c)) <= 1]
        if hit:
            out.add((min(hit), i))
        else:
            pages.append((i, c))
    return out


def history_case(seed):
    r = random.Random(seed)
    base, ids = make_codes(300, seed), {}
    for i in range(1, 1501):
        c = r.choice(base[: 1 + i // 5]) if r.random() < 0.7 else base[0]
        if c in ids.values() and r.random() < 0.2:
            k = r.randrange(10)
            c = c[:k] + r.choice("01il") + c[k + 1 :]
        ids[i] = c
    return ids


@pytest.mark.parametrize("seed", [1, 2])
def test_duplicates_against_brute_force(spark, seed):
    ids = history_case(seed)
    df = spark.createDataFrame([("t", i, i // 250, c) for i, c in ids.items()] + [("u", 1, 0, ids[1]), ("u", 2, 0, None), ("u", 3, 1, ids[1]), ("u", 4, 1, "short")], "space string, id bigint, batch bigint, code string")
    got = rows(dedup_index.duplicates(df))
    assert {(f, x) for s, f, x in got if s == "t"} == brute(ids) and [x for x in got if x[0] == "u"] == [("u", 1, 3)]
    assert dedup_index.duplicates(df.limit(0)).count() == 0


def test_rows_without_batch_arrive_last(spark):
    a, b = make_codes(2, 9)
    df = spark.createDataFrame([("t", 1, 1, a), ("t", 2, 2, b), ("t", 3, None, a), ("t", 4, None, b)], "space string, id bigint, batch bigint, code string")
    assert rows(dedup_index.duplicates(df.withColumn("number", F.lit("clash")))) == [("t", 1, 3), ("t", 2, 4)]


def test_many_small_batches_arrive_in_few_runs(spark, monkeypatch):
    ids, resolve, sizes = history_case(6), dedup_index.History.resolve, []
    monkeypatch.setattr(dedup_index.History, "resolve", lambda self, rows, n, into: (sizes.append(n), resolve(self, rows, n, into))[1])
    df = spark.createDataFrame([("t", i, i // 25, c) for i, c in ids.items()], "space string, id bigint, batch bigint, code string")  # 61 batches
    assert {(f, x) for _, f, x in rows(dedup_index.duplicates(df))} == brute(ids)
    assert 5 < len(sizes) < 25 and sum(sizes) == len(ids)
    cut = dedup_index.runs([(k, 10) for k in range(2000)])
    assert len(cut) < 45 and cut[:5] == [(k, k, 10) for k in range(5)]
    assert [k for a, b, _ in cut for k in range(a, b + 1)] == list(range(2000)) and sum(n for *_, n in cut) == 20_000


def test_incremental_history(spark, tmp_path):
    ids = history_case(3)
    h = dedup_index.History(spark, f"file://{tmp_path}/h")
    got = set()
    for b in range(0, 1501, 250):
        part = [(i, c) for i, c in ids.items() if b <= i < b + 250]
        got |= {tuple(r) for r in h.accept(spark.createDataFrame(part or [(0, None)], "id bigint, code string")).collect()}
        h.compact()
        h = dedup_index.History(spark, f"file://{tmp_path}/h")  # as the next run finds it
    assert got == brute(ids) and len(h.shards) < 7
    pages = {f for f, _ in got} | set(ids) - {x for _, x in got}
    assert sum(s["nodes"] for s in h.shards) == len(pages)  # a mistyped code is no node
    again = spark.createDataFrame([(i, c) for i, c in ids.items() if 1000 <= i < 1250], "id bigint, code string")
    assert {tuple(r) for r in h.accept(again).collect()} == {(f, x) for f, x in got if 1000 <= x < 1250}
    assert sum(s["nodes"] for s in h.shards) == len(pages)  # accepted again: no node twice


def test_a_batch_reads_only_the_segments_it_is_routed_to(spark, tmp_path, monkeypatch):
    """All other graphs are made unreadable, and so are the earlier batches' rows: none of them is needed."""
    monkeypatch.setattr(dedup_index, "SEGMENT_NODES", 16)
    codes = make_codes(700, 4)
    h = dedup_index.History(spark, f"file://{tmp_path}/h")
    for b in range(5):  # four shards are merged, so there is one of many segments and one of fewer
        h.accept(spark.createDataFrame(list(enumerate(codes[b * 140 : b * 140 + 140], b * 140)), "id bigint, code string"))
        h.compact()
    assert len(h.shards) == 2 and h.shards[0]["bits"] != h.shards[1]["bits"]
    batch = [(1000, codes[5]), (1001, codes[600][:9] + "0")]
    number = [int(c, 36) for _, c in batch]
    turned = [int(smallworld.turn(np.array([n]))[0]) for n in number]
    wanted = {(s["name"], dedup_index._folder("", ring, int(k))) for s in h.shards for ring, keys in ((0, number), (1, turned)) for k in dedup_index._segments(np.array(keys), s["bits"])}
    kept = 0
    for s in h.shards:
        for folder in (tmp_path / "h" / s["name"]).glob("graph=*"):
            if (s["name"], folder.name) in wanted:
                kept += 1
            else:
                for f in folder.glob("*.parquet"):
                    f.write_bytes(b"not a graph")
    assert 0 < kept <= 8
    known = h.resolve(spark.createDataFrame(batch, "id bigint, code string").withColumn("number", dedup_index.code_number(F.col("code"))))
    assert {(r["own_id"], r["first_id"]) for r in known.collect()} == {(1000, 5), (1001, 600)}


def test_graphs_stay_within_their_bound_as_the_history_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dedup_index, "SEGMENT_NODES", 64)
    h = dedup_index.History(spark, f"file://{tmp_path}/h")
    codes = make_codes(1600, 8)
    for b in range(4):
        h.accept(spark.createDataFrame(list(enumerate(codes[b * 400 : b * 400 + 400], b * 400)), "id bigint, code string"))
    before = h.graphs().agg(F.max("nodes")).first()[0]
    assert h.compact() == 1
    merged = h.graphs().agg(F.sum("nodes").alias("n"), F.max("nodes").alias("top"), F.count(F.lit(1)).alias("graphs")).first()
    assert merged["n"] == 2 * 1600 and merged["top"] <= 128 and before <= 128 and merged["graphs"] >= 2 * 1600 // 128


def test_graph_search_is_exact_and_its_beam_tuned():
    codes = np.array([int(c, 36) for c in make_codes(3000, 5)])
    graph = smallworld.Graph.build(codes, np.arange(len(codes)))
    q = np.concatenate([codes[:200] + 1, [0, 36**10 - 1]])
    pairs = lambda found: sorted(zip(*map(np.ndarray.tolist, found)))
    for beam in (1, 2, 5, None):
        assert pairs(graph.search(q, beam)) == pairs(graph.exhaustive(q))
    assert (graph.beam, graph.found) == (1, graph.near) and graph.sampled == smallworld.TUNE_QUERIES
    assert smallworld.turn(smallworld.turn(codes)).tolist() == codes.tolist()
    r = np.random.default_rng(1)
    dense = r.integers(0, 20, 3000) * smallworld.HALF_CODES + r.integers(0, 36**2, 3000) * 36**3
    crowd = smallworld.Graph.build(dense, np.arange(len(dense)))
    assert crowd.beam > 1 and pairs(crowd.search(dense[:300] + 36)) == pairs(crowd.exhaustive(dense[:300] + 36))
    assert len(crowd.search(dense[:300], 1, widen=False)[0]) < len(crowd.exhaustive(dense[:300])[0])
    back = smallworld.Graph.unpack(crowd.pack())
    assert (back.beam, pairs(back.search(q))) == (crowd.beam, pairs(crowd.search(q)))
    asked = graph.asked(q)
    assert {*np.unique(graph.exhaustive(q)[0]).tolist()} <= {*asked.tolist()}
    far = codes + np.arange(1, 3001) * smallworld.HALF_CODES  # with halves that are hardly any node's
    assert len(graph.asked(far)) < 300 and len(graph.asked(codes)) == 3000
    for n in range(4):
        assert len(smallworld.Graph.build(codes[:n], np.arange(n)).search(codes[:5])[0]) == n


# ---- hot keys


def test_shares(spark):
    ref = spark.createDataFrame([("A & B", ["AB LAND"]), ("ST X", None), ("Y", ["A & B"])], "country string, also_known array<string>")
    cells = ["a and b", " A\xa0& B ", "AB  land", "A&B", "St​ X", None, "", "??", "y"]
    df = spark.createDataFrame([(1, c, "x") for c in cells] + [(None, "Y", "x")], "batch int, country string, name string")
    got = {(r["batch"], r["name"]): (r["n"], r["total"]) for r in hotkeys.shares(df, "batch", "country", ref, "country", "also_known").collect()}
    assert got == {(1, "A & B"): (4, 9), (1, "ST X"): (1, 9), (1, "Y"): (1, 9), (1, None): (3, 9), (None, "Y"): (1, 1)}
    assert rows(hotkeys.heavy(hotkeys.shares(df, "batch", "country", ref, "country", "also_known"), 0.4).select("batch", "name")) == sorted([(1, "A & B"), (None, "Y")], key=repr)
    assert hotkeys.shares(df.limit(0), "batch", "country", ref, "country", "also_known").count() == 0


# ---- profiles


def details(n, load):
    r = random.Random(load)
    light = ["LOW"] * 8 + ["HIGH", None] if load < 3 else ["HIGH"] * 8 + ["low", "N/A"]
    return [(load * 1000 + i, load, r.choice(light), r.choice(["Yes", "No", " ", "\xa0N/A", "Maybe", "Yes "]), "".join(r.choices(string.ascii_uppercase, k=4)) if i % 7 else "ab1") for i in range(n)]


@pytest.fixture(scope="module")
def detail_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("p") / "detail_rows.parquet")
    data = [x for load in (1, 2, 3) for x in details(300, load)] + [(9000 + i, 5, "LOW", "Perhaps", None) for i in range(50)]
    schema = "detail_id bigint, load_no int, airport_light_intensity string, customs string, icao string"
    for part, own in enumerate([data[:450], data[450:900], data[900:]]):
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(path)
    return path, data


def test_checks_and_shifts(spark, detail_table):
    path, data = detail_table
    c = profile.checks(spark, path, profile.PATTERNS, "load_no", "detail_id")

    def cls(k, v):
        if v is None or v.strip() in ("", "N/A"):
            return "missing"
        p = profile.PATTERNS[k]
        ok = v in p if isinstance(p, tuple) else len(v) == 4 and all("A" <= x <= "Z" for x in v)
        return "=" + v if ok else "invalid"

    cols = list(profile.PATTERNS)
    want = [(k, r[1], r[0]) for r in data for k, v in zip(cols, r[2:]) if cls(k, v) == "invalid"]
    assert rows(c.cells) == sorted(want, key=repr)
    count = {}
    for r in data:
        for k, v in zip(cols, r[2:]):
            count[k, r[1], cls(k, v)] = count.get((k, r[1], cls(k, v)), 0) + 1
    assert {(r["column_name"], r["load_no"], r["class"]): r["n"] for r in c.shares.collect()} == count
    got = rows(profile.shifts(c.shares, "load_no", 0.15))
    assert ("airport_light_intensity", 3) in got and all(load != 5 for _, load in got)


def test_profile_from_footers_and_scan(spark, detail_table):
    path, data = detail_table
    got = {(r["column_name"], r["load_no"]): r for r in profile.profile(spark, path, "load_no").collect()}
    for k, name in enumerate(["airport_light_intensity", "customs", "icao"], 2):
        for load in (1, 2, 3, 5):
            v = [r[k] for r in data if r[1] == load]
            g, there = got[name, load], [x for x in v if x is not None]
            assert (g["n_rows"], g["n_missing"]) == (len(v), sum(x is None or x.strip() in ("", "N/A") for x in v))
            assert (g["low"], g["high"]) == ((min(there), max(there)) if there else (None, None))
            assert g["n_distinct"] == len(set(there))
    footers = {r["column_name"]: r for r in profile.table_profile(spark, path).collect()}
    assert footers["icao"]["n_rows"] == len(data) and footers["icao"]["nulls"] == sum(r[4] is None for r in data)
    assert footers["customs"]["with_dictionary"] == footers["customs"]["chunks"]


def test_more_column_sets_than_scans(spark, tmp_path):
    """A file for each set of open columns, one of them twice; what is settled counts from footers only. Written as loads come, each in its own file."""
    path, data, cols = str(tmp_path / "detail_rows.parquet"), [], list(profile.PATTERNS)
    once, mixed = {"airport_light_intensity": "low", "customs": "Yes", "icao": "ab1"}, {"airport_light_intensity": ["LOW", "hi"], "customs": ["No", ""], "icao": ["ABCD", "N/A"]}
    for load in range(1, 10):
        own = [(load * 100 + i, load, *(mixed[c][i % 2] if load >> k & 1 else once[c] for k, c in enumerate(cols))) for i in range(10)]
        spark.createDataFrame(own, "detail_id bigint, load_no int, airport_light_intensity string, customs string, icao string").coalesce(1).write.mode("append").parquet(path)
        data += own
    assert len({load & 7 for load in range(1, 10)} - {0}) > profile.SCANS
    checked = profile.checks(spark, path, profile.PATTERNS, "load_no", "detail_id")
    assert rows(checked.cells) == sorted([(c, r[1], r[0]) for r in data for c, v in zip(cols, r[2:]) if v in ("low", "hi", "ab1")], key=repr)
    assert {(r["column_name"], r["load_no"]): r["s"] for r in checked.shares.groupBy("column_name", "load_no").agg(F.sum("n").alias("s")).collect()} == {(c, load): 10 for c in cols for load in range(1, 10)}


def test_profile_of_more_column_sets_than_scans(spark, tmp_path):
    path, cols, missing = str(tmp_path / "t.parquet"), ["a", "b", "c"], {}
    for load in range(1, 9):
        own = [(load, *(f"{c}{i % 4}" if load >> k & 1 == 0 or i else "N/A" for k, c in enumerate(cols))) for i in range(80)]
        missing |= {(c, load): load >> k & 1 for k, c in enumerate(cols)}
        spark.createDataFrame(own, "load_no int, a string, b string, c string").coalesce(1).write.mode("append").parquet(path)
    got = {(r["column_name"], r["load_no"]): (r["n_rows"], r["n_missing"]) for r in profile.profile(spark, path, "load_no").collect()}
    assert got == {k: (80, n) for k, n in missing.items()}


def test_distinct_values_are_exact(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    data = [(1, i, f"v{i % 3000}", "x" if i % 2 else "y", "N/A" if i % 3 else None) for i in range(6000)] + [(2, i, "w", "z" * (1 + i % 3), "q") for i in range(100)]
    for load in (1, 2):
        spark.createDataFrame([r for r in data if r[0] == load], "load_no int, n bigint, a string, b string, c string").coalesce(1).write.mode("append").parquet(path)
    got = {(r["column_name"], r["load_no"]): tuple(r)[2:] for r in profile.profile(spark, path, "load_no").collect()}
    for k, name in enumerate(["n", "a", "b", "c"], 1):
        for load in (1, 2):
            cells = [r[k] for r in data if r[0] == load]
            there = {c for c in cells if c is not None}
            assert got[name, load] == (len(cells), sum(c in (None, "N/A") for c in cells), len(there), str(min(there)), str(max(there)))
    settled = {r["column_name"]: (r["chunks"], r["settled_range"], r["settled_distinct"]) for r in profile.settled_chunks(spark, path, "load_no").collect()}
    assert settled["n"] == (2, 2, 0) and settled["b"] == (2, 2, 2) and settled["c"] == (2, 1, 2)


def test_files_that_lack_a_column_and_special_numbers(spark, tmp_path):
    """A column that came later is null in the files before it; NaN is the greatest number, as in Spark; nested columns have no profile."""
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, "x"), (2, "y"), (None, "y")], "load_no int, a string").coalesce(1).write.parquet(path)
    late = spark.createDataFrame([(2, "z", 1.5, True, [1]), (2, None, float("nan"), False, None), (3, " N/A ", -2.0, None, [2])], "load_no int, a string, f double, b boolean, l array<int>")
    late.coalesce(1).write.mode("append").parquet(path)
    spark.conf.set("spark.sql.parquet.mergeSchema", "true")
    try:
        got = {(r["column_name"], r["load_no"]): tuple(r)[2:] for r in profile.profile(spark, path, "load_no").collect()}
    finally:
        spark.conf.unset("spark.sql.parquet.mergeSchema")
    assert {c for c, _ in got} == {"a", "f", "b"}
    assert got["a", 2] == (3, 1, 2, "y", "z") and got["a", None] == (1, 0, 1, "y", "y") and got["a", 3] == (1, 1, 1, " N/A ", " N/A ")
    assert got["f", 1] == (1, 1, 0, None, None) and got["f", 2] == (3, 1, 2, "1.5", "NaN") and got["f", 3] == (1, 0, 1, "-2.0", "-2.0")
    assert got["b", 2] == (3, 1, 2, "false", "true") and got["b", 3] == (1, 1, 0, None, None)


def test_ranges_in_own_type(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    data = [(1, n, f"{n}") for n in (-5, -30, 9, 60000, 9999)] + [(2, None, None)]
    spark.createDataFrame(data, "load_no int, n bigint, a string").write.parquet(path)
    for again in ("t.parquet", "u.parquet"):  # loads apart in files, where footers tell, and together in one
        spark.createDataFrame(data, "load_no int, n bigint, a string").coalesce(1).write.mode("append").parquet(str(tmp_path / "u.parquet"))
        got = {(r["column_name"], r["load_no"]): (r["n_rows"], r["n_missing"], r["low"], r["high"]) for r in profile.profile(spark, str(tmp_path / again), "load_no").collect()}
        if again == "u.parquet":
            got = {k: (v[0] // 2, v[1] // 2, *v[2:]) for k, v in got.items()}
        assert got == {("n", 1): (5, 0, "-30", "60000"), ("a", 1): (5, 0, "-30", "9999"), ("n", 2): (1, 1, None, None), ("a", 2): (1, 1, None, None)}


def test_cases_of_all_columns(spark, tmp_path):
    from fieldloom.plans import problems

    names = ["airport_link", "airport_name", "city", "country", "icao", "iata", "airport_light_intensity", "customs", "airport_of_entry", "slots_required", "open_24_hours", "facility_use", "distance_from_city", "variation", "elevation_ft"]
    good = ["https://h/Field-Info/a-b-TRUD-d7xpm2arvx", "n", "c", "X", "ABCD", "ABC", "LOW", "Yes", "No", "No", "Yes", "Private", "8 KM NNE", "01W", "-12"]
    odd = {"iata": "AB1", "slots_required": "Y", "elevation_ft": "99999", "variation": "1W", "distance_from_city": "8 MI N", "facility_use": "?", "airport_link": "/x", "open_24_hours": "yes", "airport_of_entry": "-", "customs": "Maybe"}
    data = [(load * 100 + i, load, *good) for load in (1, 2) for i in range(40)]
    bad = [(300 + i, 2, *(v if c == name else g for c, g in zip(names, good))) for i, (name, v) in enumerate(odd.items())]
    moved = [(400 + i, 3, *(("Z" if i % 2 else None) if c in ("country", "city") else g for c, g in zip(names, good))) for i in range(40)]
    spark.createDataFrame(data + bad + moved, "detail_id bigint, load_no int, " + ", ".join(f"{c} string" for c in names)).selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' as loaded_at").coalesce(1).write.parquet(str(tmp_path / "detail_rows.parquet"))
    want = [("cell", c, 2, 300 + i) for i, c in enumerate(odd)] + [("shift", "city", 3, 0), ("shift", "country", 3, 0)]
    assert rows(problems.p5_cases(spark, str(tmp_path))) == sorted(want, key=repr)
    assert {r["n_distinct"] for r in problems.p5_profile(spark, str(tmp_path)).where("column_name = 'iata' and load_no = 2").collect()} == {2}


def test_dictionaries_hold_all_values(spark, detail_table, tmp_path):
    import pandas as pd

    from fieldloom.sources.footers import chunks

    path, data = detail_table
    told = {v for r in chunks(spark, path, ["customs"]).collect() for v in r["candidates"]}
    assert told == {r[3] for r in data}
    pd.DataFrame({"a": [f"{i}-{'x' * 90}" for i in range(3000)], "b": ["q"] * 3000}).to_parquet(tmp_path / "p.parquet", dictionary_pagesize_limit=2000, compression="zstd")
    got = {r["column"]: r for r in chunks(spark, str(tmp_path / "p.parquet")).collect()}
    assert got["a"]["candidates"] is None and got["a"]["low"] is None and got["b"]["candidates"] == ["q"]
