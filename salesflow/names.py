"""Column names, month labels and constants of the sales data model."""

from __future__ import annotations

# --- fixed values: data-file formats and business constants -----------------

MONTH_CODES = ["ENE", "FEB", "MAR", "ABR", "MAY", "JUN",
               "JUL", "AGO", "SEP", "OCT", "NOV", "DIC"]
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
               "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
YTD_BLOCK = "YTD_JUL"
REPORT_METRICS = ["Venta", "TGT", "PY24", "pct"]
REPORT_ID = "Producto_Familia"
LEVEL_FAMILY = "Familia"
LEVEL_PRODUCT = "Producto"
ALL_ZONES = "Todas"
UNKNOWN_TEXT = "Desconocido"

ACCENTED = "áéíóúñÁÉÍÓÚÑ"
UNACCENTED = "aeiounAEIOUN"

PIECES_PER_BOX = 20
MAX_BINS = 500

# Raw sales headers -> standard names.
SALES_RENAMES = {
    "2025": "Venta_Valor",
    "CANTIDAD": "Venta_Cajas",
    "MES NUM": "Mes_Num",
    "MES": "Mes",
    "Nombre Cliente": "Cliente",
}
SALES_TEXT = ["Vendedor", "Nombre Cliente", "Producto", "MES"]
SALES_METRICS = ["2025", "CANTIDAD", "MES NUM"]
MASTER_TEXT = ["Producto", "Descripcion", "Numero de articulo"]
GEO_TEXT = ["zone_code", "zone_name", "region"]
REPORT_TEXT = ["Zona", "Producto"]

# Training table.
ZONE_CONTEXT = ["Meta_Zona_Cajas", "Venta_PY_Zona_Cajas",
                "Meta_Zona_Valor", "Venta_PY_Zona_Valor",
                "Meta_Zona_Piezas", "Venta_PY_Zona_Piezas"]
FAMILY_CONTEXT = ["Meta_Familia_Cajas", "Venta_PY_Familia_Cajas",
                  "Meta_Familia_Valor", "Venta_PY_Familia_Valor",
                  "Meta_Familia_Piezas", "Venta_PY_Familia_Piezas"]
TRAINING_COLUMNS = ["Region", "Nombre_Zona", "Cliente", "Producto", "ID_Articulo",
                    "Mes_Num", "Mes", "Venta_Cajas", "Venta_Piezas_Reales", "Venta_Valor",
                    "Precio_Caja", "Precio_Unitario_Pieza",
                    *ZONE_CONTEXT, "Precio_Promedio_PY_Caja", *FAMILY_CONTEXT]
CATALOGUE_COLUMNS = ["Producto", "Precio_Caja", "ID_Articulo", "Venta_PY_Zona_Cajas",
                     "Venta_PY_Familia_Cajas", "Meta_Zona_Cajas", "Precio_Promedio_PY_Caja"]
ENCODED = ["Cliente", "Producto"]  # more labels than a tree can branch on
INDEXED = ["Nombre_Zona", "Region", "Mes"]
NUMERIC = ["Precio_Caja", "Mes_Num", "Meta_Zona_Cajas", "Venta_PY_Zona_Cajas",
           "Precio_Promedio_PY_Caja", "Venta_PY_Familia_Cajas"]

# --- end of fixed values ----------------------------------------------------


def month_headers() -> list[tuple[str, str, str]]:
    """(month code, target header, prior-year header) of the wide month reports.

    The report headers are irregular: the first five months carry a space before
    the underscore, and every target header ends in a space.
    """
    out = []
    for i, (code, name) in enumerate(zip(MONTH_CODES, MONTH_NAMES)):
        stem = name + " " if i < 5 else name
        out.append((code, f"{stem}_TGT ", f"{stem}_PY 24"))
    return out


def block_labels(months: list[str] | None = None, metrics: list[str] | None = None) -> list[str]:
    """``{month}_{metric}`` labels of the block report, in file order."""
    months = [*MONTH_NAMES, YTD_BLOCK] if months is None else months
    metrics = REPORT_METRICS if metrics is None else metrics
    return [f"{m}_{k}" for m in months for k in metrics]
