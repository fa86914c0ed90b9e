import math

import pytest
from pyspark.sql import functions as F

from conftest import values
from salesflow.checks import queries
from salesflow.models import demand as d, recommend as m
from salesflow.names import ENCODED, INDEXED, NUMERIC
from salesflow.operators.ranking import catalogue, client_dimension
from salesflow.plans import sales as plan
from salesflow.session import drop_staged, stage, staged


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    rows = spark.range(3000).select(
        F.concat(F.lit("C"), i % 40).alias("Cliente"), F.concat(F.lit("P"), i % 9).alias("Producto"),
        F.concat(F.lit("Z"), i % 40 % 5).alias("Nombre_Zona"),
        F.when(i % 40 % 5 > 0, F.concat(F.lit("R"), i % 40 % 2)).alias("Region"),
        F.element_at(F.array(F.lit("ENE"), F.lit("OCT")), (i % 2 + 1).cast("int")).alias("Mes"),
        F.when(i % 2 == 0, 1).otherwise(10).alias("Mes_Num"),
        (i % 9).cast("string").alias("ID_Articulo"),
        (F.pmod(i * 37, F.lit(50)) + 5.0).alias("Precio_Caja"),
        (i % 9 * 3.0).alias("Venta_PY_Zona_Cajas"), (i % 9 * 5.0).alias("Venta_PY_Familia_Cajas"),
        (i % 5 * 2.0).alias("Meta_Zona_Cajas"), (i % 9 + 1.0).alias("Precio_Promedio_PY_Caja"),
        (F.pmod(i * 13, F.lit(20)) + i % 9).cast("int").alias("Venta_Cajas"))
    return stage(rows, "model_rows")


@pytest.fixture(scope="module")
def parts(table):
    return d.training_frame(table)


@pytest.fixture(scope="module")
def model(parts):
    return d.calibrate(d.fit(parts[0], d.forest(trees=5, depth=4)), parts[0])


def test_calibration_balances_the_totals(model, parts):
    row = model.transform(parts[0]).agg(F.sum("Venta_Cajas").alias("y"),
                                        F.sum("prediction_final").alias("p")).first()
    assert math.isclose(row.y, row.p, rel_tol=1e-9)
    one = model.transform(parts[1]).first()
    assert math.isclose(one.prediction_piezas, one.prediction_final * 20)
    assert math.isclose(one.prediction_raw, math.expm1(one.prediction))


def test_two_fits_agree_and_survive_saving(spark, model, parts, tmp_path):
    again = d.calibrate(d.fit(parts[0], d.forest(trees=5, depth=4)), parts[0])
    path = str(tmp_path / "model")
    again.save(path)
    columns = ["Cliente", "Producto", "Precio_Caja", "prediction_final"]
    expected = values(model.transform(parts[1]).select(*columns))
    assert values(d.load_model_or_none(spark, path).transform(parts[1]).select(*columns)) == expected


def test_unseen_and_null_categories_are_scored(model, parts):
    odd = parts[1].limit(1).withColumns({"Cliente": F.lit("never seen"), "Region": F.lit(None).cast("string")})
    assert model.transform(odd).first().prediction_final > 0


def test_every_client_is_its_own(spark):
    """1 500 clients of one zone: those with different histories are told apart, one pair at least in ten."""
    i = F.col("id")
    rows = spark.range(9000).select(
        F.concat(F.lit("C"), i % 1500).alias("Cliente"), F.concat(F.lit("P"), i % 7).alias("Producto"),
        F.lit("Z").alias("Nombre_Zona"), F.lit("R").alias("Region"), F.lit("OCT").alias("Mes"), F.lit(10).alias("Mes_Num"),
        F.lit("1").alias("ID_Articulo"), *[F.lit(5.0).alias(c) for c in NUMERIC if c != "Mes_Num"],
        (i % 1500 + 1).cast("int").alias("Venta_Cajas"))
    frame = d.with_log_target(rows)
    model = d.fit(frame, d.forest(trees=5, depth=5))
    assert model.encodings.where("column = 'Cliente' AND fold = -1 AND label IS NOT NULL").count() == 1500
    one = model.transform(frame.dropDuplicates(["Cliente"]).where("Cliente IN ('C3', 'C1400')"))
    low, high = [r.prediction_raw for r in one.orderBy(F.desc("Cliente")).collect()]
    assert high > low
    assert one.select("Cliente_Media").distinct().count() == 2


def test_encoding_leaves_the_own_fold_out(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 2.0), ("a", 1, 6.0), ("b", 1, 10.0), (None, 0, 1.0)],
                                 "c string, f int, y double")
    got = {(r.label, r.fold): r.value for r in d.target_encoding(rows, ["c"], "y", F.col("f"), 2.0).collect()}
    assert got == {("a", -1): 17 / 5, ("b", -1): 6.0, ("a", 0): 14 / 3, ("a", 1): 11 / 4, ("b", 1): 4.0, (None, -1): 4.0}
    encoded = d.encode(rows, stage(d.target_encoding(rows, ["c"], "y", F.col("f"), 2.0), "e"), ["c"], F.col("f"))
    assert sorted(r.c_Media for r in encoded.collect()) == [11 / 4, 4.0, 4.0, 14 / 3, 14 / 3]


def test_few_labels_are_broadcast_beside_many(spark):
    rows = spark.range(4000).selectExpr("CAST(id % 2000 AS STRING) AS many", "CAST(id % 3 AS STRING) AS few", "CAST(id AS DOUBLE) AS y")
    encodings = stage(d.target_encoding(rows, ["many", "few"], "y", F.lit(0)), "e")
    expected = values(d.encode(rows, encodings, ["many", "few"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000b")
    try:
        got = d.encode(rows, encodings, ["many", "few"])
        first = got._jdf.queryExecution().sparkPlan().toString()
        assert first.count("SortMergeJoin") == 1 and first.count("BroadcastHashJoin") == 1
        assert values(got) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_training_rows_are_narrow_and_looked_up_once(parts):
    train = parts[0].withColumn("note", F.lit("not a feature"))
    _, _, rows, held = d._features(train)
    try:
        assert held.storageLevel.useMemory and held.storageLevel.useDisk
        assert not {"note", "ID_Articulo", d.TARGET} & set(held.columns)
        assert rows.count() == train.count()
    finally:
        held.unpersist()


def test_importance_names_every_input(model, parts):
    schema = model.transform(parts[1]).schema
    rows = d.feature_importance(model, schema, 20).collect()
    assert {r.feature for r in rows} == {*(f"{c}_Index" for c in INDEXED), *(f"{c}_Media" for c in ENCODED),
                                         *NUMERIC}
    assert math.isclose(sum(r.importance for r in rows), 1.0)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert d.feature_importance(model, schema, 3).count() == 3


def test_search_picks_from_the_grid(parts, monkeypatch):
    calls = []
    fit = d.Pipeline.fit
    monkeypatch.setattr(d.Pipeline, "fit", lambda self, df: calls.append(1) or fit(self, df))
    found = d.tune(parts[0], trees=(2, 3), depths=(2, 3), folds=2)
    won = d.winning_parameters(found)
    assert won["numTrees"] in (2, 3) and won["maxDepth"] in (2, 3)
    best = min(found.search, key=lambda tried: tried[1])[0]
    assert len(found.search) == 4 and won == {k: best[k] for k in won}
    assert len(calls) == 3  # the feature stages: once for each fold, without its rows, and once for the model
    assert all(len(errors) == 2 and math.isclose(sum(errors) / 2, mean) for _, mean, errors in found.search)


def test_nested_encodings_leave_held_out_rows_out(spark):
    rows = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 1, 0, 2.0), ("a", 1, 1, 6.0), ("b", 0, 1, 10.0), (None, 1, 0, 5.0),
                                  ("c", 0, 0, None)], "c string, o int, f int, y double")
    got = {(r.held_out, r.label, r.fold): (r.n, r.value) for r in d.nested_encoding(
        rows, ["c"], "y", F.col("o"), F.col("f"), 2, 2.0).collect()}
    for held_out in (0, 1):
        left = [r for r in rows.collect() if r.o != held_out and r.y is not None]
        mean = sum(r.y for r in left) / len(left)
        assert got.pop((held_out, None, -1)) == (len(left), mean)
        for label in {r.c for r in rows.collect() if r.c and r.o != held_out}:
            own = [r for r in left if r.c == label]
            for fold in {-1, *(r.f for r in rows.collect() if r.c == label and r.o != held_out)}:
                others = [r.y for r in own if r.f != fold]
                n, value = got.pop((held_out, label, fold))
                assert n == len(others) and math.isclose(value, (sum(others) + 2 * mean) / (len(others) + 2))
    assert got == {}


def test_a_search_looks_every_column_up_once(parts, monkeypatch):
    looked_up, join = [], d.lookup_join
    monkeypatch.setattr(d, "lookup_join", lambda left, right, on, **more: looked_up.append(on) or join(left, right, on, **more))
    model = d.tune(parts[0], trees=(2,), depths=(2,), folds=3)
    assert len(looked_up) == len(ENCODED)  # not again for every fold and part of it
    monkeypatch.undo()
    plain = d.target_encoding(parts[0], ENCODED, d.LABEL, d.fold_of(parts[0]))
    assert model.encodings.columns == plain.columns and values(model.encodings) == values(plain)


def test_rows_of_a_search_hold_what_encode_looks_up(spark, monkeypatch):
    """Every search of the rows side by side against a lookup of its own; labels that are null or only held out, and rows
    that no search or every one trains on."""
    monkeypatch.setattr(d, "ENCODED", ["c", "p"])
    monkeypatch.setattr(d, "INDEXED", ["id"])
    monkeypatch.setattr(d, "NUMERIC", [])
    i = F.col("id")
    rows = stage(spark.range(300).select(
        i, F.when(i % 7 > 0, F.concat(F.lit("C"), i % 29)).alias("c"), F.when(i < 290, i % 3).otherwise(i).cast("string").alias("p"),
        F.when(i % 11 > 0, F.pmod(F.xxhash64(i), F.lit(90)) / 8.0).alias(d.LABEL), F.nullif(F.pmod(F.xxhash64(i + 5), F.lit(5)).cast("int"), F.lit(4)).alias("_outer"),
        F.pmod(F.xxhash64(i + 9), F.lit(5)).cast("int").alias("_own")), "side_by_side")
    outer, own, folds = F.col("_outer"), F.col("_own"), [0, 1, 2]
    searches = [d.ALL_ROWS, *folds]
    found = d._encode_searches(rows, stage(d._nested_means(rows, ["c", "p"], d.LABEL, outer, own, searches), "means"), searches)
    nested = stage(d.nested_encoding(rows, ["c", "p"], d.LABEL, outer, own, 3), "nested")
    assert rows.where("_outer IS NULL").count() > 0 and rows.where("_outer = 3").count() > 0 and found.count() == 300
    for s in searches:
        keys = ["id", d.mean_column("c"), d.mean_column("p")]
        if s == d.ALL_ROWS:
            whole = stage(d.target_encoding(rows, ["c", "p"], d.LABEL, own), "whole")
            assert values(d._rows_of_search(found, s), *keys) == values(d.encode(rows, whole, ["c", "p"], own), *keys)
            continue
        table = nested.where(F.col("held_out") == s).drop("held_out", "n")
        train, left = d.encode(rows.where(outer != s), table, ["c", "p"], own), d.encode(rows.where(outer == s), table, ["c", "p"])
        assert values(d._rows_of_search(found.where(outer != s), s), *keys) == values(train, *keys)
        assert values(d._rows_of_search(found.where(outer == s), s), *keys) == values(left, *keys)


def test_forests_read_features_made_once(parts):
    _, _, rows, held = d._features(parts[0])
    try:
        assert rows.columns == held.columns == ["features", d.LABEL]  # vectors are not assembled at every pass
    finally:
        held.unpersist()


def test_search_errors_are_those_of_unseen_rows(spark):
    """A target of pure noise with a client for every third row: an encoding that has seen the held-out rows would look
    better than the overall mean, a nested one cannot."""
    i = F.col("id")
    rows = spark.range(2400).select(
        F.concat(F.lit("C"), i % 800).alias("Cliente"), F.concat(F.lit("P"), i % 3).alias("Producto"),
        F.lit("Z").alias("Nombre_Zona"), F.lit("R").alias("Region"), F.lit("OCT").alias("Mes"), F.lit(10).alias("Mes_Num"),
        F.lit("1").alias("ID_Articulo"), *[F.lit(5.0).alias(c) for c in NUMERIC if c != "Mes_Num"],
        F.pmod(F.xxhash64(i), F.lit(100)).cast("int").alias("Venta_Cajas"), F.pmod(F.xxhash64(i + 7), F.lit(3)).alias("k"))
    frame = stage(d.with_log_target(rows), "noise")
    model = d.tune(frame, trees=(5,), depths=(3,), folds=3, fold_col="k")
    spread = frame.agg(F.stddev(d.LABEL)).first()[0]
    assert all(e > 0.97 * spread for e in model.search[0][2])


def test_saving_is_all_or_nothing(spark, model, parts, tmp_path, monkeypatch):
    path, columns = str(tmp_path / "m"), ["Cliente", "Producto", "Precio_Caja", "prediction_final"]
    model.save(path)
    expected = values(model.transform(parts[1]).select(*columns))
    other = d.calibrate(d.fit(parts[0], d.forest(trees=2, depth=2)), parts[0])
    for broken in ("publish_state", "current_state"):
        monkeypatch.setattr(d, broken, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            other.save(path)
        monkeypatch.undo()
        assert values(d.load_model(spark, path).transform(parts[1]).select(*columns)) == expected
    loaded = d.load_model(spark, path)
    loaded.save(path)  # onto the tables it is read from
    assert values(loaded.transform(parts[1]).select(*columns)) == expected
    assert values(d.load_model(spark, path).transform(parts[1]).select(*columns)) == expected
    assert len(d.drop_old_versions(spark, path)) == 2
    assert values(d.load_model(spark, path).transform(parts[1]).select(*columns)) == expected


def test_a_live_model_keeps_its_encodings(spark, parts):
    model = d.fit(parts[0], d.forest(trees=2, depth=2))
    drop_staged(spark, [p for p in staged(spark) if "/encodings-" not in p and "/model_rows" not in p])
    table = spark.read.schema(model.encodings.schema).parquet(*[f for f in model.encodings.inputFiles()])
    assert table.count() == model.encodings.count() > 0


def naive_recommendation(model, table, products, client, n):
    """One client at a time, the catalogue scored row by row."""
    context = client.asDict()
    grid = products.withColumns({k: F.lit(v).cast("string") for k, v in context.items()}).withColumns(
        {"Mes": F.lit("OCT"), "Mes_Num": F.lit(10)})
    rows = model.transform(grid).select("Producto", "prediction_final").collect()
    return sorted(rows, key=lambda r: (-r.prediction_final, r.Producto))[:n]


def test_all_clients_at_once_equals_one_by_one(model, table):
    products = stage(catalogue(table, 6), "products")
    clients = client_dimension(table)
    got = m.recommend(model, clients, products, "OCT", 3).collect()
    assert len(got) == 40 * 3
    for client in clients.filter("Cliente in ('C0', 'C7', 'C13')").collect():
        mine = sorted((r for r in got if r.Cliente == client.Cliente), key=lambda r: r.puesto)
        naive = naive_recommendation(model, table, products, client, 3)
        assert [(r.Producto, r.prediction_final) for r in mine] == [tuple(r) for r in naive]
        assert all(r.ingreso_estimado == r.Precio_Caja * r.prediction_final for r in mine)
        assert {(r.Region, r.Nombre_Zona) for r in mine} == {(client.Region, client.Nombre_Zona)}


def test_best_prices_match_the_curve(model, table):
    products = stage(catalogue(table, 4), "products")
    clients = client_dimension(table)
    best = m.best_prices(model, clients, products).collect()
    assert len(best) == 40
    top = m.recommend(model, clients, products, n=1)
    curve = m.price_curve(model, top).collect()
    assert len(curve) == 40 * 13
    for row in best[:8]:
        mine = [c for c in curve if c.Cliente == row.Cliente]
        winner = max(mine, key=lambda c: (c.ingreso_estimado, -c.ajuste))
        assert (row.ajuste, row.ingreso_optimo) == (winner.ajuste, winner.ingreso_estimado)
        assert row.ingreso_base == next(c.ingreso_estimado for c in mine if c.ajuste == 0)


def test_exact_prices_beat_every_step(spark, model, table):
    products = stage(catalogue(table, 4), "products")
    top = stage(m.recommend(model, client_dimension(table), products, n=1), "first")
    points = d.split_points(model, "Precio_Caja")
    assert points == sorted(set(points)) and len(points) > 3
    best = {r.Cliente: r for r in m.exact_price(model, top).collect()}
    assert len(best) == 40 and best.keys() == {r.Cliente for r in top.collect()}
    # a fine grid of prices, scored one by one, and every piece's right end
    grid = top.withColumn("precio_base", F.col("Precio_Caja")).withColumn(
        "ajuste", F.explode(F.sequence(F.lit(-3000), F.lit(3000), F.lit(20)))).withColumn(
        "Precio_Caja", F.col("precio_base") * (F.col("ajuste") + 10000) / 10000).drop(*m.PREDICTIONS, "ingreso_estimado")
    scored = model.transform(grid).groupBy("Cliente").agg(F.max(F.col("Precio_Caja") * F.col("prediction_final")).alias("most"))
    for r in scored.collect():
        mine = best[r.Cliente]
        assert mine.ingreso_optimo >= r.most * (1 - 1e-12)
        assert 0.7 * mine.precio_base <= mine.precio_optimo * (1 + 1e-12) and mine.precio_optimo <= 1.3 * mine.precio_base * (1 + 1e-12)
        ends = [p for p in points if 0.7 * mine.precio_base < p < 1.3 * mine.precio_base]
        assert any(math.isclose(mine.precio_optimo, p) for p in [*ends, mine.precio_base, 0.7 * mine.precio_base, 1.3 * mine.precio_base])
    odd = top.limit(1).withColumn("Precio_Caja", F.lit(None).cast("double")).unionByName(
        top.limit(1).withColumns({"Precio_Caja": F.lit(0.0), "Cliente": F.lit("zero")}))
    prices = {r.Cliente: r for r in m.exact_price(model, odd).collect()}
    assert len(prices) == 2 and prices["zero"].ingreso_optimo == 0 and prices["zero"].ajuste == 0
    assert m.exact_price(model, top.limit(0)).count() == 0


def test_rows_are_encoded_before_they_unfold(model, table, monkeypatch):
    products = stage(catalogue(table, 4), "products")
    looked_up, encode = [], d.encode
    monkeypatch.setattr(d, "encode", lambda df, *rest, **more: looked_up.append(df.count()) or encode(df, *rest, **more))
    assert m.best_prices(model, client_dimension(table), products).count() == 40
    assert sorted(looked_up) == [4, 40]  # neither the grid's 160 rows nor the 520 scenarios
    top = m.recommend(model, client_dimension(table), products, n=1, means=True)
    plain = top.drop(*m.MEANS)
    for priced in (m.optimise_price, m.exact_price, m.price_curve, m.discount_test):
        assert values(priced(model, top)) == values(priced(model, plain))
    assert max(looked_up) == 40


def test_scenarios_of_one_file_are_dealt(spark, tmp_path):
    parts = spark.range(60).selectExpr("id % 50 AS p_partkey", "id + 0.5D AS p_retailprice", "CAST(id % 7 AS INT) AS p_size")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = queries._fixed_scenarios(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows.count() == 60 * 13 and queries.best_price(spark, str(tmp_path)).count() == 60


def test_without_a_model_the_catalogue_is_shown(table, tmp_path):
    got = plan.recommendations(table, str(tmp_path / "none"), n=2, k=4)
    assert "prediction_final" not in got.columns and got.count() == 80
    assert {r.Producto for r in got.collect()} == {"P8", "P7"}


def test_train_job(spark, table, tmp_path):
    path = str(tmp_path / "m")
    model, errors = plan.train(table, path, search=False, trees=3, depth=3)
    assert errors.first().rmse > 0
    assert plan.prices(table, d.load_model_or_none(spark, path), k=3).count() == 40


def test_a_broken_model_is_an_error(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    assert d.load_model_or_none(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(Exception):
        d.load_model_or_none(spark, str(tmp_path / "broken"))


def test_discount(model, table):
    products = stage(catalogue(table, 4), "products")
    top = m.recommend(model, client_dimension(table), products, n=1)
    rows = m.discount_test(model, top).collect()
    assert len(rows) == 40
    for r in rows:
        assert math.isclose(r.Precio_Caja, r.precio_base * 0.9)
        assert math.isclose(r.cambio_pct, (r.demanda_nueva / r.demanda_base - 1) * 100, abs_tol=1e-9)


def test_log_scale_errors(model, parts):
    row = d.evaluate(model, parts[1], d.LABEL, "prediction").first()
    assert 0 < row.rmse < d.evaluate(model, parts[1]).first().rmse
