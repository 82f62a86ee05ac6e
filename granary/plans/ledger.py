"""Progress of a batch run: its input cut into units of whole files, and a ledger of the units that are done.

A unit is read, put through all stages and written on its own; then one small file with its rows and files is renamed into the ledger. A run
that goes on reads the plan that the first start has written, and skips the files of committed units before anything of them is opened. A
unit that was cut short left no entry and is written again over what it left.
"""

from __future__ import annotations

import dataclasses
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..sources.readers import SourceSpec, source_files
from ..storage import delete, listed, read_json, write_json

RESUME_MODES = ("auto", "beginning", "checkpoint", "ignore")
#: Bits of seq below a unit's number, and units of a source.
UNIT_BITS, UNITS = 36, 1 << 16


@dataclass(frozen=True)
class Unit:
    """Files of one source that are read together; no files: the whole source."""

    number: int
    source: int
    part: int
    files: list[str]

    def spec(self, sources: list[SourceSpec]) -> SourceSpec:
        own = sources[self.source]
        return dataclasses.replace(own, dataset=self.files) if self.files else own

    @property
    def first_seq(self) -> int:
        return (self.source << 52) + (self.part << UNIT_BITS)


def cut(spark: SparkSession, sources: list[SourceSpec], unit_bytes: int) -> list[Unit]:
    """Units in the order of the sources: neighbouring files up to so many bytes (a larger file is a unit), by name. Sources with a limit, and those that are no files, are not cut."""
    out: list[Unit] = []
    for i, s in enumerate(sources):
        files = source_files(spark, s) if s.limit_docs is None else []
        groups: list[list[str]] = []
        size = unit_bytes
        for path, n in files:
            if not groups or size + n > unit_bytes:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        if len(groups) > UNITS:
            raise ValueError(f"source {s.name} has more than {UNITS} units; take larger ones")
        # a source of one unit is read as it is given
        parts = groups if len(groups) > 1 else [[]]
        out += [Unit(len(out) + k, i, k, g) for k, g in enumerate(parts)]
    return out


class Ledger:
    """The committed units of a run below <base>/<run>."""

    def __init__(self, spark: SparkSession, base: str, run: str):
        self.spark, self.path = spark, f"{base.rstrip('/')}/{run}"

    def plan(self, sources: list[SourceSpec], unit_bytes: int, fingerprint: str) -> list[Unit]:
        """The units of the run, from its first start if there was one. Another configuration cannot go on with them."""
        known = read_json(self.spark, f"{self.path}/plan.json")
        if known is None:
            units = cut(self.spark, sources, unit_bytes)
            write_json(self.spark, f"{self.path}/plan.json", {"fingerprint": fingerprint, "units": [dataclasses.asdict(u) for u in units]})
            return units
        if known["fingerprint"] != fingerprint:
            raise ValueError("the run was started with another configuration; begin anew or take another run_id")
        return [Unit(**u) for u in known["units"]]

    def done(self) -> dict[int, dict]:
        names = [n for n, _, _ in listed(self.spark, self.path) if n.startswith("unit-") and n.endswith(".json")]
        return {e["unit"]: e for e in (read_json(self.spark, f"{self.path}/{n}") for n in names)}

    def commit(self, unit: Unit, rows: int, last_seq: int | None) -> None:
        entry = {"unit": unit.number, "source": unit.source, "files": unit.files, "rows": rows, "first_seq": unit.first_seq, "last_seq": last_seq, "committed_ms": int(time.time() * 1000)}
        write_json(self.spark, f"{self.path}/unit-{unit.number:06d}.json", entry)

    def finish(self) -> None:
        """Notes that all outputs are written, so that the next run of this name begins anew."""
        write_json(self.spark, f"{self.path}/complete.json", {"finished_ms": int(time.time() * 1000)})

    def finished(self) -> bool:
        return read_json(self.spark, f"{self.path}/complete.json") is not None

    def reset(self) -> bool:
        """Forgets all progress; whether there was any."""
        return delete(self.spark, self.path)


def run_named(spark: SparkSession, base: str, run_id: str, mode: str = "auto", named: str | None = None) -> str:
    """The run whose ledger counts. checkpoint: the run of that name, or the newest whose name begins so; the run's own if there is none."""
    if mode not in RESUME_MODES:
        raise ValueError(f"unknown resume mode {mode}; there are {', '.join(RESUME_MODES)}")
    if mode != "checkpoint" or not named:
        return run_id
    runs = [(at, n) for n, _, at in listed(spark, base) if n == named or n.startswith(named)]
    exact = [n for _, n in runs if n == named]
    return exact[0] if exact else max(runs)[1] if runs else run_id


def progress(spark: SparkSession, base: str) -> list[dict]:
    """(run, units, done, rows, committed_ms) of all runs with a ledger, the newest first."""
    out = []
    for name, _, at in listed(spark, base):
        plan = read_json(spark, f"{base.rstrip('/')}/{name}/plan.json")
        if plan is not None:
            done = Ledger(spark, base, name).done().values()
            out.append({"run": name, "units": len(plan["units"]), "done": len(done), "rows": sum(e["rows"] for e in done), "committed_ms": max((e["committed_ms"] for e in done), default=at)})
    return sorted(out, key=lambda x: (-x["committed_ms"], x["run"]))
