"""Parameterised DataFrame operators."""

from veritab.operators.aggregate import ratio_breakdown, summed_top_k
from veritab.operators.quality import Check, evaluate, gate, orphan_keys, violations
from veritab.operators.split import split_pattern
from veritab.operators.topn import top_k_per_group, top_n
