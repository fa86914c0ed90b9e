"""The same results in SQL, written on their own: name -> query for an SQL engine.

Named sub-queries below are put together per query by ``_sql``.
"""

from __future__ import annotations

from salesflow.names import (CATALOGUE_COLUMNS, FAMILY_CONTEXT, MONTH_CODES, MONTH_NAMES,
                             TRAINING_COLUMNS, YTD_BLOCK, ZONE_CONTEXT)

_CODES = "[" + ", ".join(f"'{m}'" for m in MONTH_CODES) + "]"


def _norm(c: str) -> str:
    return f"upper(trim(translate({c}, 'áéíóúñÁÉÍÓÚÑ', 'aeiounAEIOUN')))"


def _round2(ratio: str) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({ratio} AS VARCHAR) AS DECIMAL(38,22)), 2) AS DOUBLE)"


def _price(value: str, boxes: str) -> str:
    return f"CASE WHEN {boxes} > 0 THEN {_round2(f'{value} / {boxes}')} ELSE 0.0 END"


def _money(c: str) -> str:
    return f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100"


_PARTS = {
    "raw": f"""
        SELECT 'Línea - ' || n_name AS "Vendedor", c_name AS "Nombre Cliente",
               CAST(l_partkey AS VARCHAR) AS "Producto",
               {_CODES}[month(l_shipdate)] AS "MES", CAST(month(l_shipdate) AS INTEGER) AS "MES NUM",
               CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS "2025",
               CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS "CANTIDAD"
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "clean": f"""
        SELECT {_norm('"Vendedor"')} AS "Vendedor", {_norm('"Nombre Cliente"')} AS "Nombre Cliente",
               {_norm('"Producto"')} AS "Producto", {_norm('"MES"')} AS "MES",
               CAST("MES NUM" AS DOUBLE) AS "MES NUM", "2025", "CANTIDAD"
        FROM raw WHERE "2025" >= 0 AND "CANTIDAD" >= 0""",
    "facts": """
        SELECT "Vendedor", "Nombre Cliente" AS "Cliente", "Producto", "MES" AS "Mes",
               CAST("MES NUM" AS INTEGER) AS "Mes_Num", "2025" AS "Venta_Valor",
               CAST("CANTIDAD" AS BIGINT) AS "Venta_Cajas",
               trim(string_split("Vendedor", '-')[2]) AS zone_code_join,
               CAST("CANTIDAD" AS BIGINT) * 20 AS "Venta_Piezas_Reales"
        FROM clean""",
    "geo": """
        SELECT upper(n_name) AS zone_code_join, 'ZONA ' || upper(n_name) AS "Nombre_Zona",
               upper(r_name) AS "Region"
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    "enriched": f"""
        SELECT f.zone_code_join, CAST(p_partkey AS VARCHAR) AS "Producto_Key", "Region",
               "Nombre_Zona", "Cliente", coalesce(upper(p_name), f."Producto") AS "Producto",
               CAST(p_partkey AS VARCHAR) AS "ID_Articulo", "Mes_Num", "Mes", "Venta_Cajas",
               "Venta_Piezas_Reales", "Venta_Valor",
               {_price('"Venta_Valor"', '"Venta_Cajas"')} AS "Precio_Caja",
               {_round2(_price('"Venta_Valor"', '"Venta_Cajas"') + ' / 20')}
                   AS "Precio_Unitario_Pieza"
        FROM facts f LEFT JOIN geo g ON g.zone_code_join = f.zone_code_join
        LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = f."Producto\"""",
    "lines2000": """
        SELECT n_name, p_name, CAST(month(l_shipdate) AS INTEGER) AS m,
               l_quantity, l_extendedprice, l_returnflag
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN part ON p_partkey = l_partkey
        WHERE year(l_shipdate) = 2000""",
    "units": """
        SELECT n_name, p_name, m, sum(l_quantity) AS py FROM lines2000
        WHERE l_returnflag <> 'R' GROUP BY ALL""",
    "amounts": f"""
        SELECT n_name, p_name, m, {_money('l_extendedprice')} AS py FROM lines2000
        WHERE l_returnflag <> 'N' GROUP BY ALL""",
    "family_units": """
        SELECT n_name, string_split(p_name, ' ')[1] AS family, m, sum(l_quantity) AS py
        FROM lines2000 WHERE l_returnflag <> 'R' GROUP BY ALL""",
    "family_amounts": f"""
        SELECT n_name, string_split(p_name, ' ')[1] AS family, m,
               {_money('l_extendedprice')} AS py
        FROM lines2000 WHERE l_returnflag <> 'N' GROUP BY ALL""",
    "zone_ctx": f"""
        SELECT 'LINEA - ' || u.n_name AS "Zona", upper(u.p_name) AS "Producto",
               {_CODES}[u.m] AS "Mes_Corto", u.py * CAST(1.1 AS DOUBLE) AS "Meta_Zona_Cajas",
               u.py AS "Venta_PY_Zona_Cajas",
               u.py * CAST(1.1 AS DOUBLE) * 20 AS "Meta_Zona_Piezas",
               u.py * 20 AS "Venta_PY_Zona_Piezas",
               a.py * CAST(1.1 AS DOUBLE) AS "Meta_Zona_Valor", a.py AS "Venta_PY_Zona_Valor",
               upper(u.n_name) AS zone_code_join, upper(u.p_name) AS "Producto_Key"
        FROM units u JOIN amounts a USING (n_name, p_name, m)""",
    "with_zone": f"""
        SELECT *, {_price('"Venta_PY_Zona_Valor"', '"Venta_PY_Zona_Cajas"')}
                      AS "Precio_Promedio_PY_Caja"
        FROM (SELECT e.*, {', '.join(f'coalesce(z."{c}", 0.0) AS "{c}"' for c in ZONE_CONTEXT)}
              FROM enriched e LEFT JOIN zone_ctx z ON z.zone_code_join = e.zone_code_join
                   AND z."Producto_Key" = e."Producto" AND z."Mes_Corto" = e."Mes")""",
    "family_ctx": f"""
        SELECT 'LINEA - ' || n_name AS "Zona", upper(family) AS "Familia_Nom",
               {_CODES}[m] AS "Mes_Corto", u.py * CAST(1.1 AS DOUBLE) AS "Meta_Familia_Cajas",
               u.py AS "Venta_PY_Familia_Cajas",
               u.py * CAST(1.1 AS DOUBLE) * 20 AS "Meta_Familia_Piezas",
               u.py * 20 AS "Venta_PY_Familia_Piezas",
               a.py * CAST(1.1 AS DOUBLE) AS "Meta_Familia_Valor",
               a.py AS "Venta_PY_Familia_Valor",
               upper(family) AS "Family_Join_Key", upper(n_name) AS zone_code_join
        FROM family_units u FULL OUTER JOIN family_amounts a USING (n_name, family, m)""",
    "dataset": f"""
        SELECT {', '.join('w."' + c + '"' for c in TRAINING_COLUMNS if c not in FAMILY_CONTEXT)},
               {', '.join(f'coalesce(f."{c}", 0.0) AS "{c}"' for c in FAMILY_CONTEXT)}
        FROM with_zone w LEFT JOIN family_ctx f ON f.zone_code_join = w.zone_code_join
             AND f."Family_Join_Key" = string_split(w."Producto", ' ')[1]
             AND f."Mes_Corto" = w."Mes"
        WHERE "Precio_Caja" >= 0""",
    "clients": """
        SELECT DISTINCT "Cliente", "Region", "Nombre_Zona" FROM enriched""",
    "ranked": f"""
        SELECT {', '.join(f'"{c}"' for c in CATALOGUE_COLUMNS)}, row_number() OVER (
                   PARTITION BY "Producto" ORDER BY "Venta_PY_Zona_Cajas" DESC, "Precio_Caja",
                   "ID_Articulo", "Venta_PY_Familia_Cajas", "Meta_Zona_Cajas",
                   "Precio_Promedio_PY_Caja") AS rn
        FROM dataset""",
    "products": f"""
        SELECT {', '.join(f'"{c}"' for c in CATALOGUE_COLUMNS)} FROM ranked WHERE rn = 1
        ORDER BY "Venta_PY_Zona_Cajas" DESC, "Precio_Caja", "ID_Articulo", "Producto" LIMIT 50""",
    "grid": """
        SELECT c.*, p.*, 'OCT' AS "Mes", 10 AS "Mes_Num" FROM clients c CROSS JOIN products p""",
    "scored": """
        SELECT *, CAST((CAST(substr("Cliente", 10, 9) AS BIGINT) * 31
                        + CAST("ID_Articulo" AS BIGINT) * 17) % 97 + 1 AS DOUBLE)
                      AS prediction_final
        FROM grid""",
    "top5": """
        SELECT "Cliente", "Producto", "Precio_Caja", prediction_final,
               prediction_final * 20 AS prediction_piezas,
               CAST(round(CAST(CAST("Precio_Caja" * prediction_final AS VARCHAR)
                               AS DECIMAL(38,22)), 2) AS DOUBLE) AS ingreso_estimado,
               CAST(rn AS INTEGER) AS puesto
        FROM (SELECT *, row_number() OVER (PARTITION BY "Cliente"
                  ORDER BY prediction_final DESC, "Producto") AS rn FROM scored)
        WHERE rn <= 5""",
    "scenarios": """
        SELECT "Producto", precio_base * (100 + ajuste) / 100 AS "Precio_Caja", tamano,
               precio_base, ajuste,
               CAST(tamano * (10000 - (50 + 50 * ("Producto" % 4)) * ajuste) AS DOUBLE) / 100
                   AS prediction_final
        FROM (SELECT p_partkey AS "Producto", p_retailprice AS precio_base, p_size AS tamano FROM part),
             (SELECT CAST(unnest(range(-30, 31, 5)) AS INTEGER) AS ajuste)""",
    "priced": """
        SELECT *, "Precio_Caja" * prediction_final AS ingreso_estimado FROM scenarios""",
    "fixed": """
        SELECT l_quantity AS actual, CAST(l_partkey % 50 + 1 AS DOUBLE) AS predicted,
               l_quantity - (l_partkey % 50 + 1) AS r
        FROM lineitem""",
    "gaps": """
        SELECT nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax,
               nullif(l_returnflag, 'N') AS flag
        FROM lineitem""",
    "boxes": """
        SELECT p_name, string_split(p_name, ' ')[1] AS family, year(l_shipdate) AS y,
               month(l_shipdate) AS m, CAST(l_quantity AS BIGINT) AS q
        FROM lineitem JOIN part ON p_partkey = l_partkey
        WHERE year(l_shipdate) IN (2000, 2001)""",
    "blocks": f"""
        SELECT unnest([{', '.join(f"'{m}'" for m in [*MONTH_NAMES, YTD_BLOCK])}]) AS label,
               unnest(range(1, 14)) AS b""",
    "cells": """
        SELECT id, level, b, label,
               CAST(sum(q) FILTER (y = 2001 AND (m = b OR (b = 13 AND m <= 7))) AS BIGINT) AS s,
               CAST(sum(q) FILTER (y = 2000 AND (m = b OR (b = 13 AND m <= 7))) AS BIGINT) AS p
        FROM (SELECT p_name AS id, 'Producto' AS level, y, m, q FROM boxes
              UNION ALL SELECT family, 'Familia', y, m, q FROM boxes), blocks
        GROUP BY ALL""",
    "texts": """
        SELECT id, level, b, label, CAST(s AS VARCHAR) AS "Venta",
               CAST(p + p // 10 AS VARCHAR) AS "TGT", CAST(p AS VARCHAR) AS "PY24",
               CAST((100 * s) // (p + p // 10) AS VARCHAR)
                   || CASE WHEN level = 'Producto' THEN '%' ELSE '' END AS pct
        FROM cells""",
    "report": """
        SELECT id AS "Producto_Familia", upper(label) AS "Mes",
               coalesce(TRY_CAST("Venta" AS DOUBLE), 0) AS "Venta",
               coalesce(TRY_CAST("TGT" AS DOUBLE), 0) AS "TGT",
               coalesce(TRY_CAST("PY24" AS DOUBLE), 0) AS "PY24",
               coalesce(TRY_CAST(pct AS DOUBLE), 0) AS pct, level AS "Nivel"
        FROM texts""",
    "totals": """
        SELECT "Producto_Familia", "Nivel", sum("Venta") AS "Venta_Total_Anual",
               sum("TGT") AS "Target_Total_Anual", sum("PY24") AS "PY24_Total_Anual",
               avg(pct) AS "pct_Promedio"
        FROM report WHERE "Mes" <> 'YTD_JUL' GROUP BY ALL""",
    "sold": """
        SELECT r.*, p_name AS "Descripcion", CAST(p_partkey AS INTEGER) AS "Numero de articulo",
               CASE WHEN "CANTIDAD" > 0 THEN "2025" / "CANTIDAD" ELSE 0 END AS "Precio_Unitario"
        FROM raw r JOIN part ON CAST(p_partkey AS VARCHAR) = r."Producto"
        WHERE "2025" > 0 AND "CANTIDAD" >= 0""",
}

# Which named sub-queries each one reads.
_NEEDS = {
    "clean": ["raw"], "facts": ["clean"], "enriched": ["facts", "geo"],
    "units": ["lines2000"], "amounts": ["lines2000"], "family_units": ["lines2000"],
    "family_amounts": ["lines2000"], "zone_ctx": ["units", "amounts"],
    "with_zone": ["enriched", "zone_ctx"], "family_ctx": ["family_units", "family_amounts"],
    "dataset": ["with_zone", "family_ctx"], "clients": ["enriched"], "ranked": ["dataset"],
    "products": ["ranked"], "grid": ["clients", "products"], "scored": ["grid"],
    "top5": ["scored"], "priced": ["scenarios"], "cells": ["boxes", "blocks"],
    "texts": ["cells"], "report": ["texts"], "totals": ["report"], "sold": ["raw"],
}


def _whole_rows(part: str, first: str, second: str, keys: str) -> str:
    """A context part over reports whose rows have a value in every month."""
    for name in (first, second):
        part = part.replace(f"{name} ", f"(SELECT * FROM {name} QUALIFY count(py) OVER (PARTITION BY {keys}) = 12) ")
    return part


for _level, _name in (("product", "p_name"), ("family", "string_split(p_name, ' ')[1]")):
    _PARTS[f"months_by_{_level}"] = f"""
        SELECT n_name, {_name} AS {'p_name' if _level == 'product' else 'family'}, m,
               sum(l_quantity) FILTER (l_returnflag <> 'R') AS u, sum(l_extendedprice) FILTER (l_returnflag <> 'N') AS v
        FROM lines2000 GROUP BY ALL"""
    _NEEDS[f"months_by_{_level}"] = ["lines2000"]
_NEEDS["zone_ctx_row"], _NEEDS["family_ctx_row"] = _NEEDS["family_ctx"], _NEEDS["family_ctx"]
# zone context of reports by family
_PARTS["zone_ctx_row"] = _whole_rows(
    _PARTS["zone_ctx"].replace("p_name", "family").replace("FROM units", "FROM family_units").replace("amounts a", "family_amounts a"),
    "family_units", "family_amounts", "n_name, family")
_PARTS["family_ctx_row"] = _whole_rows(_PARTS["family_ctx"], "family_units", "family_amounts", "n_name, family")


def _order(name: str, seen: list[str]) -> list[str]:
    for need in _NEEDS.get(name, []):
        _order(need, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _sql(body: str, *needs: str) -> str:
    names: list[str] = []
    for need in needs:
        _order(need, names)
    if not names:
        return body
    return "WITH " + ", ".join(f"{n} AS ({_PARTS[n]})" for n in names) + " " + body


def _all(name: str) -> str:
    return _sql(f"SELECT * FROM {name}", name)


def _block_columns() -> str:
    columns = []
    for b, label in enumerate([*MONTH_NAMES, YTD_BLOCK], start=1):
        columns += [f"max(\"{k}\") FILTER (b = {b}) AS \"{label}_{k}\""
                    for k in ("Venta", "TGT", "PY24", "pct")]
    return ", ".join(columns)


_INDEXED = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", "{c}" AS label, CAST(row_number() OVER (
            ORDER BY count(*) DESC, "{c}") - 1 AS DOUBLE) AS "index"
        FROM enriched WHERE "{c}" IS NOT NULL GROUP BY "{c}\""""
    for c in ["Cliente", "Producto", "Nombre_Zona", "Region", "Mes"])

ORACLE = {
    "sales_standardised": _sql("""
        SELECT "Vendedor", "Nombre Cliente" AS "Cliente", "Producto", "MES" AS "Mes",
               "MES NUM" AS "Mes_Num", "2025" AS "Venta_Valor", "CANTIDAD" AS "Venta_Cajas"
        FROM raw""", "raw"),
    "block_rename": _sql(f"""
        SELECT id AS "Producto_Familia", {_block_columns()} FROM texts
        WHERE level = 'Producto' GROUP BY id""", "texts"),
    "cast_metrics": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS valor,
               CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS cajas
        FROM lineitem""",
    "drop_empty_rows": _sql("""
        SELECT * FROM gaps WHERE NOT (discount IS NULL AND tax IS NULL AND flag IS NULL)""",
                            "gaps"),
    "drop_incomplete_rows": _sql("""
        SELECT * FROM gaps WHERE discount IS NOT NULL AND tax IS NOT NULL
            AND flag IS NOT NULL""", "gaps"),
    "fill_defaults": _sql("""
        SELECT coalesce(discount, 0) AS discount, coalesce(tax, 0) AS tax,
               coalesce(flag, 'Desconocido') AS flag FROM gaps""", "gaps"),
    "null_profile": _sql("""
        SELECT count(*) - count(discount) AS discount, count(*) - count(tax) AS tax,
               count(*) - count(flag) AS flag FROM gaps""", "gaps"),
    "clean_sales": _all("clean"),
    "clean_audit": _sql("""
        SELECT (SELECT count(*) FROM raw) AS initial_rows, count(*) AS final_rows,
               (SELECT count(*) FROM raw) - count(*) AS removed_rows FROM clean""", "clean"),
    "positive_sales": _sql("""SELECT * FROM raw WHERE "2025" > 0""", "raw"),
    "clamp_returns": _sql("""
        SELECT "Vendedor", "Nombre Cliente", "Producto", "MES", "MES NUM",
               CASE WHEN "2025" < 0 THEN 0 ELSE "2025" END AS "2025",
               CASE WHEN "CANTIDAD" < 0 THEN 0 ELSE "CANTIDAD" END AS "CANTIDAD"
        FROM raw""", "raw"),
    "outlier_trim": """
        SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        WHERE l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)""",
    "sales_geo": _sql("""
        SELECT f.*, "Nombre_Zona", "Region" FROM facts f
        LEFT JOIN geo g ON g.zone_code_join = f.zone_code_join""", "facts", "geo"),
    "sales_enriched": _all("enriched"),
    "zone_targets_long": _sql(f"""
        SELECT 'Línea - ' || g.n_name AS "Zona", g.p_name AS "Producto",
               {_CODES}[g.m] AS "Mes_Corto", u.py * CAST(1.1 AS DOUBLE) AS "Meta_Zona_Cajas",
               u.py AS "Venta_PY_Zona_Cajas"
        FROM (SELECT DISTINCT n_name, p_name, unnest(range(1, 13)) AS m FROM lines2000) g
        LEFT JOIN units u ON u.n_name = g.n_name AND u.p_name = g.p_name AND u.m = g.m""",
                              "units"),
    "wide_report_file": _sql(f"""
        SELECT 'Línea - ' || g.n_name AS "Zona", g.p_name AS "Producto",
               {_CODES}[g.m] AS "Mes_Corto", u.py * CAST(1.1 AS DOUBLE) AS "Meta_Zona_Cajas",
               u.py AS "Venta_PY_Zona_Cajas"
        FROM (SELECT DISTINCT n_name, p_name, unnest(range(1, 13)) AS m FROM lines2000) g
        LEFT JOIN units u ON u.n_name = g.n_name AND u.p_name = g.p_name AND u.m = g.m""", "units"),
    "block_report_file": _sql(f"""
        SELECT id AS "Producto_Familia", {_block_columns()} FROM texts
        WHERE level = 'Producto' GROUP BY id""", "texts"),
    "ml_dataset_colocated": _all("dataset"),
    "zone_context": _all("zone_ctx"),
    "zone_context_row": _all("zone_ctx_row"),
    "family_context_row": _all("family_ctx_row"),
    "sales_zone_context": _all("with_zone"),
    "family_context": _all("family_ctx"),
    "ml_dataset": _all("dataset"),
    "report_long": _sql("""
        SELECT id AS "Producto_Familia", label AS "Mes", metric AS "Metrica", "Valor"
        FROM (SELECT id, label, unnest(['Venta', 'TGT', 'PY24', 'pct']) AS metric,
                     unnest(["Venta", "TGT", "PY24", pct]) AS "Valor"
              FROM texts WHERE level = 'Producto')""", "texts"),
    "report_wide": _sql("""
        SELECT * EXCLUDE ("Nivel") FROM report WHERE "Nivel" = 'Producto'""", "report"),
    "report_union": _all("report"),
    "annual_totals": _all("totals"),
    "master_sales": _all("sold"),
    "customer_features": _sql(f"""
        SELECT "Nombre Cliente", {_money('"2025"')} AS "Gasto_Total",
               sum("CANTIDAD") AS "Cantidad_Total",
               CAST(sum(CAST(round("2025" * 100) AS BIGINT)) AS DOUBLE) / (count("2025") * 100)
                   AS "Gasto_Promedio",
               sum("CANTIDAD") / count("CANTIDAD") AS "Cantidad_Promedio",
               count("Producto") AS "Frecuencia_Compra", max("MES NUM") AS "Ultimo_Mes"
        FROM sold GROUP BY "Nombre Cliente\"""", "sold"),
    "sales_annual_context": _sql("""
        SELECT s.*, t.* FROM sold s LEFT JOIN totals t
        ON t."Nivel" = 'Producto' AND t."Producto_Familia" = s."Descripcion\"""",
                                 "sold", "totals"),
    "join_audit": _sql("""
        SELECT (SELECT count(*) FROM facts) AS rows_before, count(*) AS rows_after,
               (SELECT count(*) FROM facts) = count(*) AS preserved
        FROM facts LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = "Producto\"""", "facts"),
    "dup_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "group_count": "SELECT event_type, count(*) AS \"count\" FROM events GROUP BY event_type",
    "file_drop_ingest": """
        SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events""",
    "file_drop_once": """
        SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events""",
    "annual_totals_stored": _all("totals"),
    "quantiles_stored": """
        SELECT CAST(a AS INTEGER) AS desde, CAST(b AS INTEGER) AS hasta, count(*) AS filas, true AS dentro
        FROM lineitem, (SELECT unnest([1, 2, 4, 1]) AS a, unnest([3, 2, 9, 12]) AS b)
        WHERE month(l_shipdate) BETWEEN a AND b GROUP BY a, b""",
    "outlier_trim_sketch": "SELECT count(*) AS filas, true AS dentro FROM lineitem",
    "csv_roundtrip": "SELECT * FROM documents",
    "json_roundtrip": "SELECT * FROM pages",
    "parquet_by_month": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
               strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, CAST(month(l_shipdate) AS INTEGER) AS mes
        FROM lineitem""",
    "months_rewritten": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN month(l_shipdate) = 3 THEN 2 * l_extendedprice ELSE l_extendedprice END AS l_extendedprice,
               strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, CAST(month(l_shipdate) AS INTEGER) AS mes
        FROM lineitem
        WHERE month(l_shipdate) <> 12 AND (month(l_shipdate) <> 5 OR l_returnflag <> 'R')""",
    "tune_folds": """
        WITH labelled AS (
            SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS label, l_orderkey % 3 AS third, l_suppkey % 4 AS fold,
                   l_quantity AS y FROM lineitem
            UNION ALL SELECT 'l_returnflag', l_returnflag, l_orderkey % 3, l_suppkey % 4, l_quantity FROM lineitem),
        held AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS held_out),
        seen AS (SELECT held_out, "column", label, fold, y FROM labelled JOIN held ON third <> held_out),
        overall AS (SELECT held_out, "column", count(*) AS n, avg(y) AS mean FROM seen GROUP BY ALL),
        whole AS (SELECT held_out, "column", label, sum(y) AS s, count(*) AS n FROM seen GROUP BY ALL),
        own AS (SELECT held_out, "column", label, fold, sum(y) AS s, count(*) AS n FROM seen GROUP BY ALL)
        SELECT held_out, "column", label, -1 AS fold, w.n, round((s + 20 * mean) / (w.n + 20), 9) AS value
        FROM whole w JOIN overall USING (held_out, "column")
        UNION ALL
        SELECT held_out, "column", label, CAST(o.fold AS INTEGER), w.n - o.n,
               round((w.s - o.s + 20 * mean) / (w.n - o.n + 20), 9)
        FROM own o JOIN whole w USING (held_out, "column", label) JOIN overall USING (held_out, "column")
        UNION ALL SELECT held_out, "column", NULL, -1, n, round(mean, 9) FROM overall""",
    "tune_check": _sql("""
        SELECT count(*) AS filas, CAST(4 AS BIGINT) AS puntos, CAST(12 AS BIGINT) AS errores, true AS gana_el_mejor,
               true AS errores_posibles FROM dataset""", "dataset"),
    "sample_orders": """
        SELECT o_orderkey, o_custkey
        FROM (SELECT *, ('0x' || substr(md5('42|' || o_orderkey), 1, 15))::BIGINT AS h FROM orders)
        WHERE h < CAST(230584300921369408 AS BIGINT) ORDER BY h, o_orderkey LIMIT 500""",
    "sample_parts": """
        SELECT p_partkey, p_name
        FROM (SELECT *, ('0x' || substr(md5('7|' || p_partkey), 1, 15))::BIGINT AS h FROM part)
        WHERE h < CAST(230584300921369408 AS BIGINT)""",
    "catalogue_without_model": _sql("""
        SELECT "Cliente", "Producto", "Precio_Caja", CAST(rn AS INTEGER) AS puesto
        FROM clients, (SELECT *, row_number() OVER (ORDER BY "Venta_PY_Zona_Cajas" DESC, "Precio_Caja", "ID_Articulo",
                                                    "Producto") AS rn FROM products) WHERE rn <= 5""", "clients", "products"),
    "importance_ranks": """
        SELECT CAST(10 AS BIGINT) AS filas, CAST(10 AS BIGINT) AS distintas, true AS validas""",
    "encoded_categories": """
        WITH labelled AS (
            SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS label, l_orderkey % 5 AS fold, l_quantity AS y
            FROM lineitem
            UNION ALL SELECT 'l_returnflag', l_returnflag, l_orderkey % 5, l_quantity FROM lineitem),
        overall AS (SELECT avg(l_quantity) AS mean FROM lineitem),
        whole AS (SELECT "column", label, sum(y) AS s, count(*) AS n FROM labelled GROUP BY ALL),
        own AS (SELECT "column", label, fold, sum(y) AS s, count(*) AS n FROM labelled GROUP BY ALL)
        SELECT "column", label, -1 AS fold, round((s + 20 * mean) / (n + 20), 9) AS value FROM whole, overall
        UNION ALL
        SELECT o."column", o.label, CAST(o.fold AS INTEGER), round((w.s - o.s + 20 * mean) / (w.n - o.n + 20), 9)
        FROM own o JOIN whole w USING ("column", label), overall
        UNION ALL SELECT DISTINCT "column", NULL, -1, round(mean, 9) FROM labelled, overall""",
    "recommend_check": _sql("""
        SELECT "Cliente", least(k, 5) AS filas, CAST(least(k, 5) * (least(k, 5) + 1) / 2 AS BIGINT) AS suma_puestos,
               least(k, 5) AS productos, least(k, 5) AS en_catalogo, least(k, 5) AS ingresos_bien
        FROM clients, (SELECT count(*) AS k FROM products)""", "clients", "products"),
    "price_curve_check": _sql("""
        SELECT "Cliente", CAST(13 AS BIGINT) AS escenarios, CAST(13 AS BIGINT) AS ajustes, CAST(-30 AS BIGINT) AS desde,
               CAST(30 AS BIGINT) AS hasta, CAST(13 AS BIGINT) AS precios_bien FROM clients""", "clients"),
    "best_price_exact_check": _sql("""
        SELECT "Cliente", CAST(1 AS BIGINT) AS filas, CAST(61 AS BIGINT) AS pasos, CAST(1 AS BIGINT) AS en_rango,
               CAST(1 AS BIGINT) AS ingresos_bien, CAST(1 AS BIGINT) AS no_menos FROM clients""", "clients"),
    "discount_check": _sql("""
        SELECT "Cliente", CAST(1 AS BIGINT) AS filas, CAST(1 AS BIGINT) AS bien FROM clients""", "clients"),
    "calibration_check": _sql("""
        SELECT count(*) AS filas, CAST(sum("Venta_Cajas") AS BIGINT) AS cajas, true AS iguales
        FROM dataset WHERE "Mes_Num" % 2 = 0""", "dataset"),
    "importance_check": """
        SELECT CAST(11 AS BIGINT) AS entradas, true AS suma_uno, array_to_string(list_sort([
            'Cliente_Media', 'Producto_Media', 'Nombre_Zona_Index', 'Region_Index', 'Mes_Index', 'Precio_Caja', 'Mes_Num',
            'Meta_Zona_Cajas', 'Venta_PY_Zona_Cajas', 'Precio_Promedio_PY_Caja', 'Venta_PY_Familia_Cajas']), ',') AS nombres""",
    "client_main_zone": """
        SELECT c_name AS "Cliente", r_name AS "Region", n_name AS "Nombre_Zona"
        FROM (SELECT c_name, r_name, n_name, count(*) AS n
              FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
              JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
              JOIN region ON r_regionkey = n_regionkey GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY n DESC, r_name, n_name) = 1""",
    "training_split": _sql("SELECT count(*) AS filas, true AS cuatro_quintos FROM dataset", "dataset"),
    "input_report": _sql("""
        SELECT 'master' AS tabla, count(*) AS initial_rows, count(*) AS final_rows, CAST(0 AS BIGINT) AS removed_rows,
               CAST(0 AS BIGINT) AS claves_repetidas FROM part
        UNION ALL SELECT 'geo', count(*), count(*), 0, 0 FROM nation
        UNION ALL SELECT 'sales', count(*), count(*) FILTER ("2025" >= 0 AND "CANTIDAD" >= 0),
               count(*) FILTER (NOT ("2025" >= 0 AND "CANTIDAD" >= 0)), 0 FROM raw
        UNION ALL
        SELECT t, count(*), count(*) FILTER (months = 12), count(*) FILTER (months < 12), 0 FROM (
            SELECT 'product_units' AS t, count(u) AS months FROM months_by_product GROUP BY n_name, p_name
            UNION ALL SELECT 'product_values', count(v) FROM months_by_product GROUP BY n_name, p_name
            UNION ALL SELECT 'family_units', count(u) FROM months_by_family GROUP BY n_name, family
            UNION ALL SELECT 'family_values', count(v) FROM months_by_family GROUP BY n_name, family) GROUP BY t""",
        "raw", "months_by_product", "months_by_family"),
    "model_index": _sql(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", "{c}" AS label, CAST(row_number() OVER (
            ORDER BY count(*) DESC, "{c}") - 1 AS DOUBLE) AS "index" FROM dataset GROUP BY "{c}\""""
        for c in ("Nombre_Zona", "Region", "Mes")), "dataset"),
    "model_reload_check": _sql("SELECT count(*) AS filas, count(*) AS iguales FROM dataset", "dataset"),
    "zone_clients": _sql("""SELECT DISTINCT "Nombre_Zona", "Cliente" FROM enriched""",
                         "enriched"),
    "zone_options": _sql("""
        SELECT 0 AS orden, 'Todas' AS zona
        UNION ALL SELECT DISTINCT 1, "Nombre_Zona" FROM enriched
        WHERE "Nombre_Zona" IS NOT NULL""", "enriched"),
    "client_options": _sql("""SELECT DISTINCT "Cliente" FROM enriched""", "enriched"),
    "client_dim": _all("clients"),
    "catalogue": _all("products"),
    "candidate_grid": _all("grid"),
    "top_n_per_client": _all("top5"),
    "recommendation_summary": _sql("""
        SELECT "Cliente", sum(prediction_final) AS total_cajas,
               round(avg("Precio_Caja"), 6) AS precio_promedio,
               round(sum(ingreso_estimado), 2) AS ingreso_total
        FROM top5 GROUP BY "Cliente\"""", "top5"),
    "revenue_ranking": _sql("""
        SELECT "Cliente", "Producto", ingreso_estimado FROM top5
        ORDER BY ingreso_estimado DESC, "Producto", "Cliente\"""", "top5"),
    "price_scenarios": _all("priced"),
    "discount_scenario": _sql("SELECT * FROM priced WHERE ajuste = -10", "priced"),
    "best_price": _sql("""
        SELECT "Producto", precio_base, ajuste, "Precio_Caja" AS precio_optimo,
               prediction_final AS demanda_optima, ingreso_estimado AS ingreso_optimo,
               ingreso_base, (ingreso_estimado - ingreso_base) * 100 / ingreso_base AS mejora_pct,
               CASE WHEN ajuste = 0 THEN 'keep' WHEN ajuste < 0 THEN 'lower' ELSE 'raise' END
                   AS estrategia
        FROM (SELECT *, row_number() OVER (PARTITION BY "Producto"
                         ORDER BY ingreso_estimado DESC, ajuste) AS rn,
                     max(ingreso_estimado) FILTER (ajuste = 0) OVER (PARTITION BY "Producto")
                         AS ingreso_base
              FROM priced) WHERE rn = 1""", "priced"),
    "bias_factor": _sql("""
        SELECT sum(actual) AS total_actual, sum(predicted) AS total_predicted,
               sum(actual) / sum(predicted) AS factor FROM fixed""", "fixed"),
    "error_metrics": _sql("""
        SELECT round(sqrt(avg(r * r)), 6) AS rmse, round(avg(abs(r)), 6) AS mae,
               round(1 - sum(r * r) / (count(*) * var_pop(actual)), 6) AS r2,
               round(avg(abs(r / (actual + 1))) * 100, 6) AS mape,
               round(avg(r), 6) AS mean_residual, abs(avg(r)) > 1 AS biased FROM fixed""",
                          "fixed"),
    "residual_histogram": _sql("""
        SELECT CAST(bin AS INTEGER) AS bin, round(lo + (bin - 1) * (hi - lo) / 30, 6) AS bin_from,
               round(lo + bin * (hi - lo) / 30, 6) AS bin_to, count(*) AS "rows"
        FROM (SELECT least(floor(30 * (r - lo) / (hi - lo)) + 1, 30) AS bin, lo, hi
              FROM fixed, (SELECT min(r) AS lo, max(r) AS hi FROM fixed))
        GROUP BY bin, lo, hi""", "fixed"),
    "split_by_hash": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'test' END AS parte
        FROM orders""",
    # Spark writes the capital of ß as SS.
    "normalise_text": f"""
        SELECT doc_id, {_norm("replace(text, 'ß', 'SS')")} AS texto FROM documents""",
    "zone_code": """
        SELECT c_custkey, vendedor, trim(string_split(vendedor, '-')[2]) AS zona
        FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Venta - ' || n_name
                  WHEN 1 THEN 'Venta - ' || n_name || ' - X' ELSE 'Venta ' || n_name END AS vendedor
              FROM customer JOIN nation ON n_nationkey = c_nationkey)""",
    "family_key": "SELECT p_partkey, string_split(p_name, ' ')[1] AS familia FROM part",
    "unit_price": f"""
        SELECT *, {_round2('precio_caja / 20')} AS precio_pieza
        FROM (SELECT l_orderkey, l_linenumber, l_extendedprice,
                     {_price('l_extendedprice', '(l_quantity - 1)')} AS precio_caja FROM lineitem)""",
    "pieces": """
        SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) * 20 AS piezas FROM lineitem""",
    "log_target": """
        SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 9) AS log_venta,
               round(exp(ln(1 + l_quantity)) - 1, 9) AS venta FROM lineitem""",
    "month_dim": f"""
        SELECT {_CODES}[month(l_shipdate)] AS mes, CAST(month(l_shipdate) AS INTEGER) AS mes_num,
               count(*) AS lineas FROM lineitem GROUP BY month(l_shipdate)""",
    "elasticity_class": """
        SELECT p_partkey, base, nueva,
               CASE WHEN nueva * 100 >= base * 101 THEN 'elastic'
                    WHEN nueva > base THEN 'inelastic' ELSE 'atypical' END AS clase
        FROM (SELECT p_partkey, p_size * 1000 AS base,
                     p_size * (1000 + (p_partkey % 7 - 2) * 5) AS nueva FROM part)""",
    "indexed_categories": _sql(_INDEXED, "enriched"),
}
ORACLE["customer_features_stored"] = ORACLE["customer_features"]
