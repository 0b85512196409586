"""Array numerics over a vocabulary axis: one ``ARRAY<FLOAT>`` of logits per token row, never exploded."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rubrica.functions.text import let


def log_sum_exp(x: Column) -> Column:
    zero = F.lit(0.0)
    return let(
        F.array_max(x), lambda top: top + F.ln(F.aggregate(x, zero, lambda total, v: total + F.exp(v - top)))
    )


def _doubles(logits: Column) -> Column:
    return logits.cast("array<double>")


def log_softmax(logits: Column) -> Column:
    return let(_doubles(logits), lambda x: let(log_sum_exp(x), lambda z: F.transform(x, lambda v: v - z)))


def entropy(logits: Column) -> Column:
    """Entropy of softmax(logits); undefined terms count as zero, so logits of only -inf give zero."""

    def bits(x: Column, z: Column) -> Column:
        return -F.aggregate(x, F.lit(0.0), lambda s, v: s + F.nanvl(F.exp(v - z) * (v - z), F.lit(0.0)))

    return let(_doubles(logits), lambda x: let(log_sum_exp(x), lambda z: bits(x, z)))


def label_log_prob(logits: Column, label: Column) -> Column:
    """Log-probability of a 0-based label."""
    return let(_doubles(logits), lambda x: F.element_at(x, label.cast("int") + 1) - log_sum_exp(x))
