"""Prompt and embedding data engine on Spark: numbered chunks, request files, strict answers, joined results."""

from lotwise.functions.adapters import ModelAdapter, adapter_for, register_adapter
from lotwise.functions.prompts import PromptTemplate, register_prompt, render
from lotwise.operators.scoring import score_embeddings, score_text, score_to
from lotwise.plans.collect import collect, good_results, rejected_lines, run_collect
from lotwise.plans.prepare import prepare
from lotwise.plans.spec import JobSpec, Layout
from lotwise.sources.results import read_results, read_states
from lotwise.sources.tables import read_input, stage_dataset
from lotwise.streaming.collect import stream_collect
from lotwise.streaming.status import fold_events, read_log

__all__ = [
    "JobSpec",
    "Layout",
    "ModelAdapter",
    "PromptTemplate",
    "adapter_for",
    "collect",
    "fold_events",
    "good_results",
    "prepare",
    "read_input",
    "read_log",
    "read_results",
    "read_states",
    "register_adapter",
    "register_prompt",
    "rejected_lines",
    "render",
    "run_collect",
    "score_embeddings",
    "score_text",
    "score_to",
    "stage_dataset",
    "stream_collect",
]
