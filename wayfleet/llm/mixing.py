"""Mixing to target weights by iterative proportional fitting, then sampling.

Token weights are summed by cell (source, language, topic). Raking scales the
cell weights to each marginal in turn until all of them hold. A document is
kept with a probability in proportion to its cell's scale, drawn from a digest
of its key, so the expected tokens of the sample have the target shares.

The number of cells is bounded by the targets, not by the data: a value without
a target of its own is counted as ``OTHER``, so there are at most
(targets + 1) per dimension, and only this cell table comes to the driver.

Values without a target (null ones too) keep the share of tokens they have in the
table, and the listed targets share out the rest, so such rows are sampled like all
others. A dimension without any listed value in the table is left out of the raking.

Defined results: null values of a dimension are OTHER; a text without words
weighs 0 tokens and is kept with its cell's probability; a marginal whose
target value has no tokens is left out and the others are rescaled; rows of one key
share one draw; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
_DIGITS = 13
_WORD = r"[^\x20\x09-\x0D]+"


def uniform(key: Column, salt: str) -> Column:
    """Number in (0, 1) that the key decides."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(salt), F.coalesce(key.cast("string"), F.lit("null")))), 1, _DIGITS)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16 ** _DIGITS)


def tokens(text: Column) -> Column:
    """Number of words of a whole text."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(_WORD)).cast("long")


def register(text: Column) -> Column:
    """Coarse topic of a whole text by its form: 'table', 'symbols', 'shouting', 'records' or 'prose'."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / size
    return (F.when(share(r"\|") > 0.02, "table").when(share(r"[#$%&*]") > 0.1, "symbols")
            .when(share(r"[A-Z]") > 0.3, "shouting").when(share(r"[0-9]") > 0.01, "records").otherwise("prose"))


def rake(totals: np.ndarray, margins: list[np.ndarray | None], rounds: int = 200, tolerance: float = 1e-10) -> np.ndarray:
    """Cell weights with the shape of ``totals`` whose sums along each axis meet the margins; an axis without one is free."""
    fitted = totals.astype(float)
    for _ in range(rounds):
        moved = 0.0
        for axis, target in enumerate(margins):
            if target is None:
                continue
            others = tuple(a for a in range(fitted.ndim) if a != axis)
            have = fitted.sum(axis=others)
            factor = np.divide(target, have, out=np.ones_like(have), where=have > 0)
            shape = [1] * fitted.ndim
            shape[axis] = -1
            fitted = fitted * factor.reshape(shape)
            moved = max(moved, float(np.abs(factor - 1).max(initial=0.0)))
        if moved < tolerance:
            break
    return fitted


def mix(docs: DataFrame, targets: dict[str, dict[str, float]], key_col: str = "doc_id", weight_col: str = "tokens",
        salt: str = "mix", keep: str | float = "most", prefix: str = "", unlisted: str = "observed") -> DataFrame:
    """``docs`` with cell, calibrated weight, probability and kept (the last three named after ``prefix``).

    ``targets`` gives each dimension column the wanted share of tokens by value.
    ``keep``: "most" scales the largest probability to 1; a number is the
    share of all tokens the sample should have, as far as probabilities of at
    most 1 allow.
    ``unlisted``: "observed" lets values without a target keep their share;
    "none" wants no tokens of them, they get weight and probability 0.
    """
    dims = list(targets)
    values = {d: sorted(set(map(str, targets[d])) | {OTHER}) for d in dims}
    cell = {d: F.when(F.col(d).cast("string").isin(values[d]), F.col(d).cast("string")).otherwise(F.lit(OTHER)) for d in dims}
    labelled = docs.withColumns({f"cell_{d}": c for d, c in cell.items()})
    sums = labelled.groupBy(*[f"cell_{d}" for d in dims]).agg(F.sum(weight_col).alias("total")).collect()  # at most one row per cell of the targets
    totals = np.zeros([len(values[d]) for d in dims])
    for row in sums:
        totals[tuple(values[d].index(row[f"cell_{d}"]) for d in dims)] += float(row["total"] or 0)
    margins = []
    for axis, d in enumerate(dims):
        have = totals.sum(axis=tuple(a for a in range(totals.ndim) if a != axis))
        wanted = np.array([float(targets[d].get(v, 0.0)) for v in values[d]]) * (have > 0)
        rest = have * [unlisted == "observed" and v == OTHER and OTHER not in targets[d] for v in values[d]]
        if wanted.sum() > 0:
            margins.append(wanted / wanted.sum() * (totals.sum() - rest.sum()) + rest)
        else:
            margins.append(None if unlisted == "observed" else wanted)
    fitted = rake(totals, margins)
    ratio = np.divide(fitted, totals, out=np.zeros_like(totals), where=totals > 0)
    scale = 1 / ratio.max() if ratio.max(initial=0.0) > 0 else 0.0
    if keep != "most" and ratio.max(initial=0.0) > 0:
        low, high = 0.0, 1 / ratio[ratio > 0].min()
        for _ in range(100):
            scale = (low + high) / 2
            low, high = (scale, high) if (np.minimum(1, ratio * scale) * totals).sum() < float(keep) * totals.sum() else (low, scale)
    table = [(*[values[d][i] for d, i in zip(dims, at, strict=True)], round(float(ratio[at]), 6), round(min(1.0, float(ratio[at] * scale)), 6))
             for at in np.ndindex(*totals.shape)]
    schema = ", ".join(f"cell_{d} string" for d in dims) + f", {prefix}weight double, {prefix}probability double"
    cells = docs.sparkSession.createDataFrame(table, schema)
    return (labelled.join(F.broadcast(cells), [f"cell_{d}" for d in dims])  # bounded by the targets
            .withColumn(f"{prefix}kept", uniform(F.col(key_col), salt) < F.col(f"{prefix}probability")))
