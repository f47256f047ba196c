"""Configured work: the reports and their runner, the quality suite, the job."""

from veritab.plans.job import JobResult, load_inputs, run_job, stage_inputs
from veritab.plans.quality import (
    basic_checks,
    intermediate_checks,
    run_quality,
    standard_suite,
)
from veritab.plans.reports import REPORTS, ReportStatus, report, run_reports, status_frame
