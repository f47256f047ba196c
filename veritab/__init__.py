"""veritab - data-quality checks and reports over tabular business data, on Spark.

The main entry points::

    from veritab import quality, evaluate, gate, violations   # checks
    from veritab import standard_suite, run_quality           # the input suite
    from veritab import REPORTS, run_reports, run_job          # reports, whole job
"""

from veritab.operators import quality
from veritab.operators.quality import Check, evaluate, gate, violations
from veritab.plans.job import load_inputs, run_job, stage_inputs
from veritab.plans.quality import run_quality, standard_suite
from veritab.plans.reports import REPORTS, report, run_reports

__version__ = "0.1.0"

__all__ = [
    "Check", "REPORTS", "evaluate", "gate", "load_inputs", "quality", "report", "run_job",
    "run_quality", "run_reports", "stage_inputs", "standard_suite", "violations",
]
