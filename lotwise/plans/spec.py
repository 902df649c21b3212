"""Job specification and storage layout."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from lotwise import fixed


LIMITS = ("max_num_jobs", "max_records_per_job", "max_records_total")


def _from_environment(name: str) -> int | None:
    """A positive whole number from the environment; None where the variable is unset or empty."""
    text = os.environ.get(name, "").strip()
    if not text:
        return None
    if not text.isdigit() or int(text) == 0:
        raise ValueError(f"{name} must be a positive whole number: {text!r}")
    return int(text)


@dataclass(frozen=True)
class JobSpec:
    """What to prepare: one input, one model, optional prompt and limits.

    ``root`` is the storage folder of all runs; ``order_by`` names the columns that
    fix the row order (input order when empty); ``unique_ids`` refuses own record ids
    that repeat inside a chunk (they multiply in the join otherwise); ``run_id`` tells
    runs with the same prefix apart in job names and record ids. Without one, record ids
    carry a fingerprint of the source files and this spec, so answers to another table
    never match. Limits are whole numbers; 0 jobs or records per job means no limit.

    ``multi_line`` reads CSV values with line breaks, at the price of one task per file.
    For large CSV files without such values switch it off, so that files are split; ``"split"`` splits
    files with such values at the price of a second reading.
    """

    job_name_prefix: str
    model_id: str
    root: str = "."
    input_uri: str | None = None
    dataset_id: str | None = None
    split: str = "train"
    prompt_id: str | None = None
    max_num_jobs: int | None = None
    max_records_per_job: int | None = None
    max_records_total: int | None = None
    order_by: Sequence[str] = ()
    order_is_unique: bool = False
    null_policy: str = "literal"
    multi_line: bool | str = True
    unique_ids: bool = False
    output_glob: str = fixed.OUTPUT_FILE_GLOB
    run_id: str = ""
    request_options: Mapping[str, Any] = field(default_factory=dict)
    extras: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, str):
                object.__setattr__(self, f.name, value.strip())
        for name in LIMITS:
            value = getattr(self, name)
            if value is not None and (type(value) is not int or value < 0):
                raise ValueError(f"{name} must be a whole number that is not negative: {value!r}")
        if self.multi_line not in (True, False, "split"):
            raise ValueError(f'multi_line must be true, false or "split": {self.multi_line!r}')
        if self.max_records_total == 0:
            raise ValueError("max_records_total must be positive when given")

    @classmethod
    def from_mapping(cls, job: Mapping[str, Any]) -> JobSpec:
        """From a job document; unknown keys are kept in ``extras``."""
        job = dict(job)
        if "s3_uri" in job and "input_uri" not in job:
            job["input_uri"] = job.pop("s3_uri")
        if job.get("split", "") is None:
            job.pop("split")
        known = {f.name for f in fields(cls)} - {"extras"}
        extras = {k: v for k, v in job.items() if k not in known}
        return cls(**{k: v for k, v in job.items() if k in known}, extras=extras)

    def check_source(self) -> None:
        if (self.input_uri is None) == (self.dataset_id is None):
            raise ValueError("give exactly one of input_uri and dataset_id")

    @property
    def chunk_size(self) -> int:
        return self.max_records_per_job or _from_environment(fixed.RECORDS_PER_JOB_ENV) or fixed.DEFAULT_RECORDS_PER_JOB

    @property
    def row_limit(self) -> int | None:
        """Rows to keep: the smaller of the total limit and jobs times chunk size; None means all."""
        total = self.max_records_total
        if total is None:
            total = _from_environment(fixed.TOTAL_RECORDS_ENV)
        by_jobs = self.max_num_jobs * self.chunk_size if self.max_num_jobs else None
        given = [n for n in (total, by_jobs) if n is not None]
        return min(given) if given else None

    @property
    def layout(self) -> Layout:
        return Layout(self.root, self.job_name_prefix)


@dataclass(frozen=True)
class Layout:
    """Folders of one run; inside each, ``chunk_idx=N`` partitions."""

    root: str
    prefix: str

    def _at(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}/{part}"

    @property
    def inputs(self) -> str:
        return self._at("inputs")

    @property
    def requests(self) -> str:
        return self._at("requests")

    @property
    def outputs(self) -> str:
        return self._at("outputs")

    @property
    def results(self) -> str:
        return self._at("results")

    @property
    def manifest(self) -> str:
        return self._at("manifest")

    @property
    def rejected_inputs(self) -> str:
        return self._at("rejected_inputs")

    @property
    def ledger(self) -> str:
        return self._at("ledger")
