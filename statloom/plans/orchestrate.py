"""Which calculations run for which imports, and in what order."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

#: Ranks within a stage: what the graph's shape needs, then derived points, then what comes after all.
_SHAPE = "STAT_VAR_GROUPS LINKED_EDGES PROVENANCE_SUMMARY NODE_PROPERTIES".split()
_POINTS = "PLACE_AGGREGATION STAT_VAR_AGGREGATION ENTITY_AGGREGATION STAT_VAR_SERIES_AGGREGATION STAT_VAR_CALCULATION SUPER_ENUM_AGGREGATION".split()
_LAST = "EMBEDDING_GENERATION MATERIALIZED_EDGES".split()
PRIORITY = {k: i for i, k in enumerate(_SHAPE)} | {k: 10 + i for i, k in enumerate(_POINTS)} | dict.fromkeys(_LAST, 20)
GLOBAL = {"STAT_VAR_GROUPS", "NODE_PROPERTIES", "EMBEDDING_GENERATION", "MATERIALIZED_EDGES"}
WORKERS = 10


@dataclass
class Step:
    kind: str
    inputs: list[str]
    output: str | None = None
    stage: int = 1
    disabled: bool = False
    name: str = ""
    config: dict = field(default_factory=dict)


def check(steps: Iterable[Step]) -> list[str]:
    """What is wrong with the configuration."""
    return [f"{s.name or s.kind}: unknown type {s.kind}" for s in steps if s.kind not in PRIORITY] + [f"{s.name or s.kind}: no inputs" for s in steps if s.kind not in GLOBAL and not s.inputs]


def applies(step: Step, import_name: str) -> bool:
    return not step.disabled and step.kind not in GLOBAL and ("*" in step.inputs or import_name in step.inputs)


def expanded(steps: list[Step], active: list[str]) -> list[str]:
    """Active imports and, in turn, the outputs of what applies to them."""
    out, queue = list(dict.fromkeys(active)), deque(active)
    while queue:
        name = queue.popleft()
        for s in steps:
            if applies(s, name) and s.output and s.output not in out:
                out.append(s.output)
                queue.append(s.output)
    return out


def ordered(steps: list[Step], import_name: str) -> list[list[Step]]:
    """Steps of an import by stage, each stage in order of priority."""
    mine = [s for s in steps if applies(s, import_name)]
    return [sorted((s for s in mine if s.stage == k), key=lambda s: PRIORITY[s.kind]) for k in sorted({s.stage for s in mine})]


def outputs(steps: list[Step], imports: list[str]) -> list[str]:
    """Imports whose earlier results go before a run."""
    return sorted({s.output for s in steps for i in imports if applies(s, i) and s.output})


def run(steps: list[Step], active: list[str], execute: Callable[[Step, str | None], None], delete: Callable[[list[str]], None] | None = None) -> list[tuple[str, str | None]]:
    """Deletes earlier results, runs every import's steps stage by stage (up to ``WORKERS`` imports at a time), then
    the global ones by priority. Returns (step, import) in the order of their ends; a failure ends the run."""
    imports, done = expanded(steps, active), []
    if delete and (gone := outputs(steps, imports)):
        delete(gone)

    def one(name: str) -> None:
        for stage in ordered(steps, name):
            for s in stage:
                execute(s, name)
                done.append((s.name or s.kind, name))

    # an import that another one's calculation makes waits for that one
    level, rest = [i for i in imports if i in active], [i for i in imports if i not in active]
    while level:
        with ThreadPoolExecutor(WORKERS) as pool:
            list(pool.map(one, level))
        made = {s.output for s in steps for i in level if applies(s, i)}
        level = [i for i in rest if i in made]
        rest = [i for i in rest if i not in made]
    for s in sorted((s for s in steps if s.kind in GLOBAL and not s.disabled), key=lambda s: PRIORITY[s.kind]):
        execute(s, None)
        done.append((s.name or s.kind, None))
    return done
