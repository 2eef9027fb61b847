import pytest

from feedloom.operators.index import (UNKNOWN_INDEX, apply_index, encode_interactions, fit_encoders, fit_index,
                                      index_size, invert_index, load_mapping, require_fitted, save_mapping)


def _training(spark):
    """Ids whose first-seen order is neither alphabetic nor by frequency."""
    return spark.createDataFrame(
        [(0, "zed", "quilt"), (1, "amy", "bowl"), (2, "zed", "apron"), (3, "bob", "bowl"), (4, "bob", "quilt")],
        "ordinal long, user_id string, item_id string")


def _mapping(df):
    return {r.value: r.idx for r in df.collect()}


def test_first_seen_numbers_and_cold_start(spark):
    users, items = fit_encoders(_training(spark), order=["ordinal"])
    assert _mapping(users) == {"zed": 0, "amy": 1, "bob": 2} and _mapping(items) == {"quilt": 0, "bowl": 1, "apron": 2}
    assert index_size(items).first().size == 3
    later = spark.createDataFrame([("amy", "vase"), ("eve", "apron"), (None, "quilt")], "user_id string, item_id string")
    got = {(r.user_id, r.item_id): (r.user_idx, r.item_idx) for r in encode_interactions(later, users, items).collect()}
    assert got == {("amy", "vase"): (1, UNKNOWN_INDEX), ("eve", "apron"): (UNKNOWN_INDEX, 2), (None, "quilt"): (UNKNOWN_INDEX, 0)}


def test_there_is_no_order_to_fall_back_to(spark):
    for bare in (_training(spark), _training(spark).drop("ordinal")):
        with pytest.raises(ValueError, match="row order"):
            fit_encoders(bare)
    with pytest.raises(ValueError, match="row order"):
        fit_index(_training(spark), "user_id", [])


def test_contract_table_has_its_order_by_default(spark):
    rows = [("b", "x", 5, 0), ("a", "z", 9, 1), ("a", "y", 2, 2), ("b", "w", 1, 3)]
    table = spark.createDataFrame(rows, "user_id string, item_id string, timestamp_ms long, ordinal long")
    users, items = fit_encoders(table)
    assert _mapping(users) == {"a": 0, "b": 1} and _mapping(items) == {"y": 0, "z": 1, "w": 2, "x": 3}


def test_saved_mapping_inverts(spark, tmp_path):
    _, items = fit_encoders(_training(spark), order=["ordinal"])
    save_mapping(items, str(tmp_path / "m"))
    back = load_mapping(spark, str(tmp_path / "m"))
    asked = spark.createDataFrame([(2,), (-1,), (0,), (77,), (None,)], "idx int")
    got = [(r.idx, r.value) for r in invert_index(asked, back, "idx", "value").collect()]
    assert sorted(got, key=str) == sorted([(2, "apron"), (-1, None), (0, "quilt"), (77, None), (None, None)], key=str)


def test_fit_needs_both_identifier_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        fit_encoders(spark.createDataFrame([("quilt", 1)], "item_id string, ordinal long"))


def test_null_id_at_fit_raises_and_empty_mapping_is_not_fitted(spark):
    df = spark.createDataFrame([(0, "a"), (1, None)], "ordinal long, v string")
    with pytest.raises(ValueError, match="null identifiers"):
        fit_index(df, "v", ["ordinal"])
    empty = fit_index(spark.createDataFrame([], "ordinal long, v string"), "v", ["ordinal"])
    with pytest.raises(ValueError, match="not been fitted"):
        require_fitted(empty)


def test_first_seen_order_is_partition_independent(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, f"id{rnd.randrange(300)}") for i in range(4000)]
    expected = {}
    for _, v in rows:
        expected.setdefault(v, len(expected))
    for parts in (1, 4, 16):
        df = spark.createDataFrame(rows, "ordinal long, v string").repartition(parts)
        got = {r.value: r.idx for r in fit_index(df, "v", ["ordinal"], partitions=parts).collect()}
        assert got == expected


def test_null_id_at_transform_is_unknown(spark):
    mapping = fit_index(spark.createDataFrame([(0, "None")], "ordinal long, v string"), "v", ["ordinal"])
    df = spark.createDataFrame([(None,)], "v string")
    assert apply_index(df, mapping, "v", "i").first().i == UNKNOWN_INDEX
