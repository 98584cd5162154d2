"""Chains of steps over one DataFrame: generators first, then validators, with records kept on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptloom.operators.inference import Model, spread
from promptloom.operators.records import keep_origin
from promptloom.plans.specs import PromptSpec
from promptloom.sources.datasets import record_step, save_records


@dataclass
class AgenticRun:
    """Named generator and validator specs run in order over a table of records.

    Names in ``order`` that are not known are ignored. Every step's answers are stored before the next one
    reads them, so a lost executor never repeats a model call of an earlier step; what follows from them is not written.
    """

    generators: Mapping[str, PromptSpec]
    validators: Mapping[str, PromptSpec]
    model: Model
    order: Sequence[str] | None = None
    record_dir: str | None = None
    record_steps: bool = False
    record_results: bool = False
    save_path: str | None = None
    save_keys: Sequence[str] | None = None
    keep_only_valid: bool = False

    def steps(self) -> list[PromptSpec]:
        known = {**self.generators, **self.validators}
        return [known[name] for name in (self.order or known) if name in known]

    def check(self, columns: Sequence[str]) -> None:
        """Every step finds its input columns among the given ones and earlier outputs. Runs no job."""
        have = set(columns)
        for step in self.steps():
            # A step with its own preparation fills in columns, so it checks itself when applied.
            absent = [k for k in step.inputs if k not in have] if step.before is None else []
            if absent:
                raise ValueError(f"step {step.name} needs {absent}; available: {sorted(have)}")
            have |= {*step.inputs, *step.output_type, f"{step.name}_input", f"{step.name}_output"}

    def spot_check(self, df: DataFrame) -> bool:
        """Run all steps on one record and throw the result away; tells whether any record came out. Verdicts do not count here."""
        return not self._fold(df.limit(1), 0, record=False, judge=False).isEmpty()

    def run(self, df: DataFrame, start_from: int = 0, spot_check: bool = False) -> DataFrame:
        if start_from == 0:
            self.check(df.columns)
        if spot_check and not self.spot_check(df):
            raise ValueError("the spot check produced no record")
        out = self._fold(df, start_from, record=True)
        if self.record_results and self.record_dir:
            record_step(out, self.record_dir, None)
        if self.save_path:
            save_records(out, self.save_path, self.save_keys)
        return out

    def _fold(self, df: DataFrame, start_from: int, record: bool, judge: bool = True) -> DataFrame:
        for step in self.steps()[start_from:]:
            df = keep_origin(step.run(df, self.model))
            if record and self.record_steps and self.record_dir:
                record_step(df, self.record_dir, step.name)
            if judge and step.validator and self.keep_only_valid:
                df = df.filter(F.col(step.verdict_field))
        return df


def chain(df: DataFrame, steps: Sequence[tuple[str, PromptSpec]], model: Model) -> DataFrame:
    """Plain chain: each step's prompt stays in ``<name>_prompt``."""
    df = spread(df)
    for name, spec in steps:
        df = spec.run(df, model).withColumnRenamed("prompt", f"{name}_prompt")
    return df
