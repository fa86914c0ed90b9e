"""Price, volume and strategy expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesflow.functions.text import _col
from salesflow.names import PIECES_PER_BOX


def unit_price(value: Column | str, quantity: Column | str, scale: int | None = 2) -> Column:
    """Value per unit, 0.0 where nothing (or an unknown quantity) was sold."""
    value, quantity = _col(value), _col(quantity)
    ratio = value / quantity
    if scale is not None:
        ratio = F.round(ratio, scale)
    return F.when(quantity > 0, ratio).otherwise(F.lit(0.0))


def piece_price(box_price: Column | str, per_box: int = PIECES_PER_BOX) -> Column:
    return F.round(_col(box_price) / per_box, 2)


def pieces(boxes: Column | str, per_box: int = PIECES_PER_BOX) -> Column:
    """Boxes -> pieces. Integer boxes are widened first: int * 20 can overflow."""
    boxes = _col(boxes)
    return boxes * F.lit(per_box).cast("bigint")


def revenue(price: Column | str, demand: Column | str, scale: int | None = None) -> Column:
    amount = _col(price) * _col(demand)
    return amount if scale is None else F.round(amount, scale)


def scenario_price(price: Column | str, pct: Column | str) -> Column:
    """Price after a change of ``pct`` per cent, with whole-number steps kept exact."""
    return _col(price) * (F.lit(100) + _col(pct)) / 100


def change_pct(base: Column | str, new: Column | str) -> Column:
    """Relative change in per cent; null when the base is zero."""
    base, new = _col(base), _col(new)
    return F.try_divide((new - base) * 100, base)


def elasticity_class(base: Column | str, new: Column | str, elastic_from: float = 1.0) -> Column:
    """Volume reaction to a price cut: inelastic below the threshold, elastic from it on,
    atypical when the volume does not grow or the change is undefined."""
    change = change_pct(base, new)
    return (F.when((change > 0) & (change < elastic_from), "inelastic")
            .when(change >= elastic_from, "elastic")
            .otherwise("atypical"))


def price_strategy(pct: Column | str, keep_below: float = 1.0) -> Column:
    """What the best price change means: keep, lower or raise."""
    pct = _col(pct)
    return F.when(F.abs(pct) < keep_below, "keep").when(pct < 0, "lower").otherwise("raise")
