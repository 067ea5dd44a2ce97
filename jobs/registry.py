"""The jobs as queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import cohort_release, patch_intake


def queries() -> dict[str, Callable]:
    return {"job1_patch_intake": patch_intake.job1_patch_intake, "job2_cohort_release": cohort_release.job2_cohort_release}


def oracle_sql() -> dict[str, str]:
    return {"job1_patch_intake": patch_intake.SQL, "job2_cohort_release": cohort_release.SQL}
