"""Small hand-made input files in the formats the jobs read."""

import json
from pathlib import Path

from salesflow.names import MONTH_CODES, block_labels, month_headers

MASTER = """Producto;Descripcion;Numero de articulo
ELIPTIC;Eliptic PF;101
GOTA;Gota Ñ Extra;102
SIN;;103
"""
SALES = """Vendedor;Nombre Cliente;Producto;MES;MES NUM;2025;CANTIDAD
Línea - Z1;Clínica Uno; eliptic ;ENE;1;100.5;10
Línea - Z1;Clínica Uno;GOTA;feb;2;50;0
Línea - Z2 - X;Botica Dos;ELIPTIC;ENE;1;33.33;3
Línea - Z9;Botica Dos;OTRO;MAR;3;20;2
Sin zona;Tres;GOTA;ENE;1;10;1
Línea - Z1;Tres;GOTA;ENE;1;-5;1
Línea - Z1;Tres;GOTA;ENE;1;12%;1
;;;;;;
Línea - Z2;;SIN;ENE;1;8;4
"""
GEO = [{"zone_code": "Z1", "zone_name": "Lima Norte", "region": "Costa"},
       {"zone_code": " z2", "zone_name": "Cusco", "region": "Sierra"}]


def report(rows: dict[tuple[str, str], dict[str, tuple]]) -> str:
    """CSV of a wide month report; every month not given is 1,1."""
    headers = [h for _, t, p in month_headers() for h in (t, p)]
    lines = [",".join(["Zona", "Producto", *headers])]
    for (zone, product), months in rows.items():
        cells = []
        for code in MONTH_CODES:
            cells += ["" if v is None else str(v) for v in months.get(code, (1, 1))]
        lines.append(",".join([zone, product, *cells]))
    return "\n".join(lines) + "\n"


PRODUCT_UNITS = report({("Línea - Z1", "Eliptic"): {"ENE": (11, 10), "FEB": (None, 3)},
                        ("Línea - Z2", "Eliptic"): {"ENE": (5, -4)},
                        ("Línea - Z1", "Gota"): {"FEB": (7, 0)}})
PRODUCT_VALUES = report({("Línea - Z1", "Eliptic"): {"ENE": (300, 205)},
                         ("Línea - Z2", "Eliptic"): {"ENE": (50, 40)}})
FAMILY_UNITS = report({("Línea - Z1", "Eliptic"): {"ENE": (20, 16)},
                       ("Línea - Z1", "Eliptic Kids"): {"ENE": (2, 4)}})
FAMILY_VALUES = report({("Línea - Z1", "Eliptic"): {"ENE": (500, 400)},
                        ("Línea - Z1", "Gota"): {"FEB": (9, 8)}})


def block(rows: list[list[str]]) -> str:
    return "\n".join(";".join(r + [""] * (1 + len(block_labels()) - len(r))) for r in rows) + "\n"


def write_inputs(folder: Path) -> dict[str, str]:
    texts = {"master": MASTER, "sales": SALES, "product_units": PRODUCT_UNITS,
             "product_values": PRODUCT_VALUES, "family_units": FAMILY_UNITS,
             "family_values": FAMILY_VALUES}
    paths = {}
    for name, text in texts.items():
        path = folder / f"{name}.csv"
        path.write_text(text, encoding="utf-8")
        paths[name] = str(path)
    geo = folder / "geo.json"
    geo.write_text("\n".join(json.dumps(g) for g in GEO))
    return paths | {"geo": str(geo)}
