from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import types as TY
from tidemark.operators import schema as S

COLS = "table_name string, column_name string, ordinal_position int, data_type string"


def cols(spark, rows):
    return spark.createDataFrame(rows, COLS)


def drift_set(df):
    return sorted((r["column_name"], r["change_type"], r["old_definition"], r["new_definition"],
                   r["status"]) for r in df.collect())


def test_drift_all_kinds_at_once(spark):
    src = cols(spark, [("t", "id", 1, "integer"), ("t", "name", 2, "character varying"),
                       ("t", "amount", 3, "numeric"), ("t", "note", 4, "text")])
    tgt = cols(spark, [("t", "ID", 1, "NUMBER(38,0)"), ("t", "NAME", 2, "VARCHAR(16777216)"),
                       ("t", "AMOUNT", 3, "FLOAT"), ("t", "LEGACY", 4, "TEXT")])
    out = drift_set(S.detect_drift(src, tgt))
    assert out == sorted([
        ("AMOUNT", "type_changed", "FLOAT", "NUMERIC(18,4)", "pending_review"),
        ("LEGACY", "column_dropped", "TEXT", None, "pending_review"),
        ("NOTE", "column_added", None, "TEXT", "auto_resolved"),
    ])


def test_drift_case_and_varchar_length_are_not_changes(spark):
    src = cols(spark, [("t", "Id", 1, "integer"), ("t", "name", 2, "varchar")])
    tgt = cols(spark, [("t", "ID", 1, "INTEGER"), ("t", "NAME", 2, "VARCHAR(16777216)")])
    assert drift_set(S.detect_drift(src, tgt)) == []


def test_drift_raw_base_names_without_folding(spark):
    src = cols(spark, [("t", "note", 1, "text")])
    tgt = cols(spark, [("t", "NOTE", 1, "VARCHAR(16777216)")])
    assert drift_set(S.detect_drift(src, tgt, fold_synonyms=False))[0][1] == "type_changed"
    assert drift_set(S.detect_drift(src, tgt)) == []


def test_drift_missing_target_gives_nothing(spark):
    src = cols(spark, [("t", "id", 1, "integer"), ("u", "id", 1, "integer")])
    tgt = cols(spark, [("u", "ID", 1, "INTEGER")])
    assert drift_set(S.detect_drift(src, tgt)) == []


def test_type_map_and_unmapped(spark):
    df = spark.createDataFrame([("integer",), ("serial",), ("smallint",), ("json",), ("numeric",)], "t string")
    got = [r[0] for r in df.select(TY.map_type("t")).collect()]
    assert got == ["INTEGER", "INTEGER", "TEXT", "TEXT", "NUMERIC(18,4)"]
    b = spark.createDataFrame([("VARCHAR(500)",), (" text ",), ("NUMBER(38,0)",)], "t string")
    assert [r[0] for r in b.select(TY.canonical_base("t")).collect()] == ["VARCHAR", "VARCHAR", "NUMBER(38,0)"]


def test_cast_report_overflow_and_long_text(spark):
    df = spark.createDataFrame([(1e20, "x" * 501, 5), (1.23456, "ok", None)],
                               "amount double, name string, n int")
    defs = [("amount", "numeric"), ("name", "character varying"), ("n", "integer")]
    rep = {r["column_name"]: r for r in TY.cast_report(df, defs).collect()}
    assert rep["amount"]["n_failed"] == 1 and rep["amount"]["n_values"] == 2
    assert rep["name"]["n_too_long"] == 1 and rep["name"]["n_failed"] == 0
    assert rep["n"]["n_values"] == 1
    cast = TY.cast_to_target(df, defs).collect()
    assert cast[0]["amount"] is None and cast[1]["amount"] == Decimal("1.2346")
    assert len(cast[0]["name"]) == 501  # reported, never cut


def test_cast_unmapped_and_nested_to_text(spark):
    df = spark.createDataFrame([([1, 2], 3)], "a array<int>, b smallint")
    out = TY.cast_to_target(df, [("a", "ARRAY"), ("b", "smallint")]).first()
    assert out["a"] == "[1,2]" and out["b"] == "3"


def test_suggest_watermark_and_keys(spark):
    c = cols(spark, [("t", "id", 1, "integer"), ("t", "Updated_At", 2, "text"),
                     ("t", "last_update_ts", 3, "timestamp without time zone"),
                     ("t", "update_note", 4, "text"), ("u", "x", 1, "date")])
    flags = {r["column_name"]: r["is_suggested_watermark"] for r in S.suggest_watermark(c).collect()}
    assert flags == {"id": False, "Updated_At": True, "last_update_ts": True,
                     "update_note": False, "x": False}
    keys = {r["table_name"]: (r["merge_key_column"], r["watermark_column"])
            for r in S.suggest_load_keys(c).collect()}
    assert keys == {"t": ("id", "Updated_At"), "u": (None, None)}
    summ = {r["table_name"]: (r["n_columns"], r["has_watermark"]) for r in S.schema_summary(c).collect()}
    assert summ == {"t": (4, True), "u": (1, False)}
    tree = {r["table_name"]: [x["name"] for x in r["columns"]] for r in S.schema_tree(c).collect()}
    assert tree["t"] == ["Updated_At", "id", "last_update_ts", "update_note"]


def test_user_tables_like_wildcard(spark):
    c = cols(spark, [("pg_stat", "a", 1, "text"), ("pgxtab", "a", 1, "text"), ("orders", "a", 1, "text")])
    assert sorted(r[0] for r in S.user_tables(c).select("table_name").collect()) == ["orders"]


def test_heal_and_align(spark):
    target = spark.createDataFrame([(1, "a", 2.0)], "ID long, NAME string, OLD double")
    batch = spark.createDataFrame([(2, "b", "new")], "ID int, NAME string, EXTRA string")
    healed, aligned = S.heal_and_align(target, batch)
    assert healed.columns == ["ID", "NAME", "OLD", "EXTRA"]
    assert aligned.columns == ["ID", "NAME", "OLD", "EXTRA"]
    assert dict(aligned.dtypes)["ID"] == "bigint"
    r = aligned.first()
    assert r["OLD"] is None and r["EXTRA"] == "new"


def test_type_change_check_and_apply(spark):
    t = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    rep = S.type_change_check(t, {"v": "INTEGER"}).first()
    assert (rep["n_values"], rep["n_failed"]) == (2, 1)
    assert [r[0] for r in S.apply_type_change(t, "v", "INTEGER").collect()] == [1, None, None]


def test_drift_state_and_pending(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        (1, 10, t, "A", "type_changed", "X", "Y", "pending_review"),
        (2, 10, t, "B", "column_dropped", "X", None, "pending_review"),
        (3, 99, t, "C", "column_added", None, "TEXT", "auto_resolved")],
        "id long, pipeline_id long, detected_at timestamp_ntz, column_name string, "
        "change_type string, old_definition string, new_definition string, status string")
    res = spark.createDataFrame([(1, t, 7)], "drift_id long, resolved_at timestamp_ntz, resolved_by long")
    state = S.drift_state(log, res)
    st = {r["id"]: r["status"] for r in state.collect()}
    assert st == {1: "resolved", 2: "pending_review", 3: "auto_resolved"}
    pipes = spark.createDataFrame([(10, "p10")], "id long, name string")
    pend = S.pending_drift(state, pipes).collect()
    assert [(r["id"], r["pipeline_name"]) for r in pend] == [(2, "p10")]
    detected = spark.createDataFrame([(10, "B", "column_dropped"), (10, "A", "type_changed")],
                                     "pipeline_id long, column_name string, change_type string")
    assert [r["column_name"] for r in S.new_drift_events(detected, state).collect()] == ["A"]


from hypothesis import given, settings, strategies as st  # noqa: E402

_SRC_TYPES = ["integer", "bigint", "text", "character varying", "numeric", "date",
              "timestamp without time zone", "double precision", "json", "boolean"]
_TGT_TYPES = ["INTEGER", "BIGINT", "TEXT", "VARCHAR(500)", "VARCHAR(16777216)", "NUMERIC(18,4)",
              "NUMBER(38,0)", "DATE", "TIMESTAMP", "FLOAT", "BOOLEAN"]


def _model(src, tgt):
    """Brute-force drift on dicts: name -> mapped type vs name -> reported type."""
    smap = {n.upper(): TY.TYPE_MAP.get(t, "TEXT") for n, t in src}
    tmap = {n.upper(): t.upper() for n, t in tgt}
    base = lambda t: t.split("(")[0].strip().upper()
    out = []
    for n, t in smap.items():
        if n not in tmap:
            out.append((n, "column_added", None, t, "auto_resolved"))
        elif base(tmap[n]) != base(t):
            out.append((n, "type_changed", tmap[n], t, "pending_review"))
    for n, t in tmap.items():
        if n not in smap:
            out.append((n, "column_dropped", t, None, "pending_review"))
    return sorted(out, key=repr)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(list("abcdefg")), st.sampled_from(_SRC_TYPES), max_size=6),
       st.dictionaries(st.sampled_from(list("ABCDEFG")), st.sampled_from(_TGT_TYPES), min_size=1,
                       max_size=6))
def test_drift_matches_brute_force(spark, src, tgt):
    s = cols(spark, [("t", n, i + 1, t) for i, (n, t) in enumerate(src.items())])
    g = cols(spark, [("t", n, i + 1, t) for i, (n, t) in enumerate(tgt.items())])
    got = sorted(((r["column_name"], r["change_type"], r["old_definition"], r["new_definition"],
                   r["status"]) for r in S.detect_drift(s, g, fold_synonyms=False).collect()), key=repr)
    assert got == _model(list(src.items()), list(tgt.items()))


def test_types_that_are_and_are_not_the_same(spark):
    same = [("INTEGER", "NUMBER(38,0)"), ("BIGINT", "number(38, 0)"), ("TEXT", "VARCHAR(500)"), ("NUMERIC(18,4)", "DECIMAL(18,4)"),
            ("NUMBER", "INTEGER"), ("TIMESTAMP", "TIMESTAMP_NTZ(9)"), ("FLOAT", "DOUBLE PRECISION")]
    other = [("INTEGER", "NUMERIC(18,4)"), ("NUMERIC(18,4)", "NUMBER(18,2)"), ("NUMERIC(10,4)", "NUMBER(18,4)"),
             ("TEXT", "INTEGER"), ("DATE", "TIMESTAMP"), ("TIMESTAMP", "TIMESTAMP_TZ"), ("FLOAT", "NUMBER(18,4)")]
    df = spark.createDataFrame(same + other, "a string, b string")
    got = [r[0] for r in df.select(TY.canonical_base(F.upper("a")) == TY.canonical_base(F.upper("b"))).collect()]
    assert got == [True] * len(same) + [False] * len(other)


def test_drift_by_fingerprints_compares_changed_tables_only(spark):
    from tidemark.operators.schema import detect_drift, detect_drift_changed, drifted_tables
    cols = "table_name string, column_name string, ordinal_position int, data_type string"
    src = spark.createDataFrame([
        ("same", "a", 1, "integer"), ("same", "b", 2, "text"),
        ("typed", "a", 1, "integer"), ("more", "a", 1, "text"), ("more", "b", 2, "text"),
        ("twice", "x", 1, "text"), ("twice", "X", 2, "integer"),
        ("null", None, 1, "text"), ("null", "q", 2, None), ("new", "a", 1, "text"), (None, "a", 1, "text")], cols)
    tgt = spark.createDataFrame([
        ("same", "B", 1, "VARCHAR(16777216)"), ("same", "A", 2, "NUMBER(38,0)"),
        ("typed", "A", 1, "NUMBER(10,2)"), ("more", "A", 1, "TEXT"),
        ("twice", "X", 1, "VARCHAR(16777216)"), ("twice", "X", 2, "NUMBER(38,0)"),
        ("null", None, 1, "TEXT"), ("null", "Q", 2, None), ("gone", "A", 1, "TEXT"), (None, "A", 1, "TEXT")], cols)
    for fold in (True, False):
        key = repr
        want = sorted(map(tuple, detect_drift(src, tgt, fold).where("table_name is not null").collect()), key=key)
        got = sorted(map(tuple, detect_drift_changed(src, tgt, fold).collect()), key=key)
        assert got == want and len(got) > 4
    found = {r["table_name"]: (r["n_source"], r["n_target"], r["drifted"]) for r in drifted_tables(src, tgt).collect()}
    assert found == {"same": (2, 2, False), "typed": (1, 1, True), "more": (2, 1, True), "twice": (2, 2, True),
                     "null": (2, 2, True), "gone": (0, 1, True)}
