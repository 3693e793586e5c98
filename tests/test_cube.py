from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
import world
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.operators import cube, staging
from quintacube.operators.dimensions import build_dimensions


@pytest.fixture(scope="module")
def built(shop):
    stg = staging.build_staging(shop)
    dims = {name: dim.cache() for name, dim in build_dimensions(shop, stg).items()}
    given = cube.cube_input(stg, dims)
    return stg, dims, given, cube.build_cube(given).cache()


def test_whole_cube_equals_brute_force(built):
    _, dims, _, fact = built
    assert world.natural(fact, dims) == world.cube()


def test_each_grouping_alone_equals_its_part_of_the_cube(built):
    _, dims, given, _ = built
    expected = world.cube()
    for keys in cube.grouping_sets():
        gid = cube.gid_of(keys)
        rows = world.natural(cube.cube_set(given, keys), dims)
        assert rows == {k: v for k, v in expected.items() if k[0] == gid}, keys


def test_grouping_sets_and_ids_are_complete():
    sets = cube.grouping_sets()
    assert len(sets) == len(set(sets)) == 32
    assert sorted(cube.gid_of(s) for s in sets) == list(range(32))
    assert cube.gid_of(()) == 31 and cube.gid_of(cube.KEYS) == 0


def test_heavy_keys_are_few_and_found(built):
    _, _, given, _ = built
    rows = cube.sales_grain(given)
    for parts in (2, 3, 8, 40):
        heavy = cube.heavy_keys(rows, ("cpf", "produto"), parts)
        assert all(len(values) < parts for values in heavy.values())
        assert (100 in heavy["cpf"]) == (parts >= 8)


@pytest.mark.parametrize("parts", ["1", "3", "200"])
def test_cube_is_the_same_however_many_keys_are_heavy(spark, built, parts):
    _, dims, given, _ = built
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert world.natural(cube.build_cube(given), dims) == world.cube()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cube_is_the_same_with_shuffle_joins_only(spark, built, monkeypatch):
    _, dims, given, _ = built
    monkeypatch.setattr(cube, "small_side", lambda lookup: lookup)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert world.natural(cube.build_cube(given), dims) == world.cube()
        one = world.natural(cube.cube_set(given, ("idCliente", "idLoja", "idProduto")), dims)
        gid = cube.gid_of(("idCliente", "idLoja", "idProduto"))
        assert one == {k: v for k, v in world.cube().items() if k[0] == gid}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_sales_no_rows(built):
    stg, dims, _, _ = built
    given = cube.cube_input({**stg, "vendas": stg["vendas"].limit(0)}, dims)
    assert cube.build_cube(given).count() == 0
    assert cube.cube_set(given, ()).count() == 0
    assert cube.cube_set(given, ("idData", "idLoja")).count() == 0


def test_unknown_members_drop_only_from_their_own_groupings(built):
    _, _, _, fact = built

    def quantity(*keys):
        return cube.cube_slice(fact, keys).agg(F.sum("quantidade")).first()[0]

    everything = sum(s["quantidade"] for s in world.SALES)
    assert quantity() == quantity("idData") == quantity("idFuncionario") == everything
    for key in ("idCliente", "idLoja", "idProduto"):
        known = sum(s["quantidade"] for s in world.SALES if world.key_of(s, key) is not None)
        assert known < everything
        assert quantity(key) == quantity("idData", key) == known


def test_null_key_is_not_the_all_member(spark, built):
    stg, dims, _, _ = built
    no_day = stg["vendas"].withColumn("tb010_012_data", F.lit(None).cast("timestamp_ntz"))
    given = cube.cube_input({**stg, "vendas": no_day}, dims)
    fact = cube.build_cube(given)
    assert fact.where("gid < 16").count() == 0  # bit 16 clear: grouped by date
    assert cube.cube_slice(fact, ()).count() == 1


def test_too_wide_cost_type_is_refused(built):
    stg, dims, _, _ = built
    given = cube.cube_input(stg, dims, cost_type="decimal(28,8)")
    with pytest.raises(ValueError, match="decimals"):
        cube.cube_set(given, ("idProduto",))


def test_measure_types_follow_the_parameter(built):
    stg, dims, _, _ = built
    given = cube.cube_input(stg, dims, cube.Measures("int", "decimal(12,2)"))
    for fact in (cube.build_cube(given), cube.cube_set(given, ("idData",))):
        types = dict(fact.dtypes)
        assert types["quantidade"] == "int" and types["valor"] == types["lucro"] == "decimal(12,2)"


def amounts(spark, *values):
    return spark.createDataFrame(
        [(i % 2, i, v and Decimal(v), v and Decimal(v) + Decimal(i * 12345679 - 7).scaleb(-8)) for i, v in enumerate(values)],
        "k int, quantidade bigint, valor decimal(27,2), lucro decimal(37,8)",
    )


@pytest.mark.parametrize(
    ("values", "columns"),
    [
        (("0.01", "-7.25", None, "123.40"), ["quantidade", "valor", "lucro"]),
        (("1.00", "99999999999.99", "-0.01", "-5.55", "2.00", "-0.03"), ["quantidade", "valor", "lucro_unidades", "lucro_fracao"]),
        (("99999999999.99", "-0.01", "-5.55", None), ["quantidade", "valor", "lucro_unidades", "lucro_fracao"]),
        (("9999999999999999.99", "-0.07", None, "-1.00"), ["quantidade", "valor_unidades", "valor_fracao", "lucro_unidades", "lucro_fracao"]),
        (("9999999999999999999999999.99", "-0.07", None, "0.01"), ["quantidade", "valor", "lucro"]),
    ],
)
def test_sums_of_whole_numbers_equal_sums_of_decimals(spark, values, columns):
    rows = amounts(spark, *values)
    numbers = cube._Numbers(rows)
    assert numbers.names == columns
    found = numbers.joined(numbers.split(rows).groupBy("k").agg(*numbers.sums()))
    expected = rows.groupBy("k").agg(*[F.sum(c).alias(c) for c in cube.MEASURES])
    assert found.schema["lucro"].dataType == expected.schema["lucro"].dataType
    assert sorted(found.select("k", *cube.MEASURES).collect()) == sorted(expected.collect())


def test_a_partition_of_the_cube_takes_a_bounded_number_of_grain_rows(spark, built, monkeypatch):
    _, dims, given, _ = built
    grain = cut(cube.sales_grain(given))
    monkeypatch.setattr(cube, "GRAIN_ROWS_A_PARTITION", 1)
    asked = []
    monkeypatch.setattr(cube, "heavy_keys", lambda rows, keys, parts, *more: asked.append(parts) or {k: [] for k in keys})
    fact = cube.build_cube(given, grain)
    assert asked == [max(8, grain.count())]
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [cpf" in plan and "Sort [produto" in plan
    assert world.natural(fact, dims) == world.cube()


def test_groupings_without_the_store_are_read_from_those_with_it(built, spark):
    """Written once each; a slice of any of the 32 groupings reads one folder, and none is lost for an unknown store."""
    _, _, given, fact = built
    given = replace(given, stores=given.stores.limit(1))
    written = cut(cube.summed_groupings(given), partition_by="gid")
    assert written.select("gid").distinct().count() <= 24
    found = cube.all_groupings(written)
    assert found.schema == written.schema
    whole = cube.build_cube(given).collect()
    assert Counter(found.select(*cube.COLUMNS).collect()) == Counter(whole) and found.where("idLoja IS NULL").count() == 0
    for keys in cube.grouping_sets():
        rows = cube.cube_slice(found, keys)
        gid = cube.gid_of(keys)
        assert Counter(rows.select(*cube.COLUMNS).collect()) == Counter(r for r in whole if r["gid"] == gid)
        assert len({f.split("gid=")[1].split("/")[0] for f in rows.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) <= 1
