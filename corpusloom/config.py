"""Configuration: sources, names, completion markers, run identity."""

from __future__ import annotations

import difflib
import hashlib
import json
import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from .operators.normalize import Source


def read_config(path: str) -> dict:
    """A YAML or JSON file whose root is a mapping; an empty file is an empty one."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        found = json.loads(text or "{}")
    else:
        import yaml

        found = yaml.safe_load(text)
    if found is None:
        return {}
    if not isinstance(found, dict):
        raise ValueError(f"the root of {path} isn't a mapping")
    return found


def sources(config: dict, mode: str | None = None) -> list[Source]:
    """corpus.sources.<handler>[] over corpus.defaults; a flat `sources` list only where there is no corpus block; entries of another mode are dropped."""
    corpus = config.get("corpus")
    if corpus is not None:
        entries = [{**corpus.get("defaults", {}), **e} for block in (corpus.get("sources") or {}).values() for e in block or []]
    else:
        entries = list(config.get("sources") or [])
    known = set(Source.__dataclass_fields__)
    kept = [e for e in entries if mode is None or e.get("mode", mode) == mode]
    return [Source(**{k: v for k, v in e.items() if k in known}) for e in kept]


def by_name(known: Sequence[Source], wanted: Sequence[str]) -> list[Source]:
    """The named sources, each once, in the order of the configuration; an unknown name is an error with close matches."""
    names = [s.name for s in known]
    for w in wanted:
        if w not in names:
            close = difflib.get_close_matches(w, names, 3)
            raise KeyError(f"unknown source {w!r}" + (f"; did you mean {', '.join(close)}?" if close else ""))
    return [s for s in known if s.name in set(wanted)]


def in_domain(known: Sequence[Source], domain: str) -> list[Source]:
    """Sources of a domain; those without one are of 'unknown'."""
    return [s for s in known if (s.domain or "unknown") == domain]


def identity(*parts: object) -> str:
    """Twenty hex digits for what a run depends on: the same for equal values whatever the order of keys."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:20]


def refuse_drift(path: str, run: dict, may_change: Sequence[str] = ("seed",)) -> None:
    """Remember what a run was started with; refuse to go on in its folder with anything else, but for may_change."""
    marker = os.path.join(path, "_RUN.json")
    if os.path.exists(marker):
        with open(marker) as f:
            before = json.load(f)
        changed = sorted(k for k in {*before, *run} if k not in may_change and before.get(k) != run.get(k))
        if changed:
            raise ValueError(f"{path} was begun with other {', '.join(changed)}")
    os.makedirs(path, exist_ok=True)
    with open(marker, "w") as f:
        json.dump(run, f, sort_keys=True)


def check_pipeline(config: dict) -> dict:
    """A clustering and packing configuration: weights and context shares add up to 1, contexts hold two tokens or more, limits are positive."""
    weights = config.get("weights", {"words": 0.8, "pieces": 0.2})
    contexts = {int(k): float(v) for k, v in config.get("contexts", {8192: 1.0}).items()}
    if abs(sum(weights.values()) - 1) > 1e-6:
        raise ValueError("feature weights must add up to 1")
    if not contexts or min(contexts) < 2 or abs(sum(contexts.values()) - 1) > 1e-6:
        raise ValueError("contexts must be 2 or more, with shares that add up to 1")
    limits = {k: int(config.get(k, d)) for k, d in (("clusters", 128), ("max_open", 4096), ("max_documents", 32), ("max_same_host", 2))}
    if min(limits.values()) < 1:
        raise ValueError("limits must be positive")
    return {"weights": weights, "contexts": contexts, **limits}


def finished(path: str, run: dict | None = None, rows: int | None = None) -> dict:
    """The marker of a finished run, checked: no limit was set, its identity and rows are as expected."""
    from .sources.sinks import read_marker

    found = read_marker(path)
    if found.get("limit") is not None:
        raise ValueError(f"{path} holds a limited sample")
    if run is not None and found.get("identity") != identity(run):
        raise ValueError(f"{path} was made by another run")
    if rows is not None and found.get("rows", 0) != rows:
        raise ValueError(f"{path} declares {found.get('rows')} rows, {rows} are there")
    return found


def find_finished(root: str, source: str | None = None) -> dict[str, dict]:
    """Folders below a root whose run finished, with what it declared; of one source only, if named by its marker or by the folder."""
    found = {}
    for folder, _, names in os.walk(root):
        if "_DECLARED.json" in names:
            with open(os.path.join(folder, "_DECLARED.json")) as f:
                said = json.load(f)
            if source is None or source in (said.get("source"), said.get("archive_name"), os.path.basename(folder)):
                found[folder] = said
    return dict(sorted(found.items()))


def select_inventory(root: str, wanted: Sequence[str] | None = None) -> tuple[dict[str, dict], dict[str, str]]:
    """(folders to take, folder or name -> why it isn't taken).  A list of wanted sources is strict: one that isn't finished is an error; without one, what isn't fit is skipped."""
    every, skipped = find_finished(root), {}
    kept = {}
    for folder, said in every.items():
        if said.get("limit") is not None:
            skipped[folder] = "holds a limited sample"
        elif not said.get("rows", 1):
            skipped[folder] = "empty"
        else:
            kept[folder] = said
    if wanted is None:
        return kept, skipped
    of = {name: [f for f, said in kept.items() if name in (said.get("source"), said.get("archive_name"), os.path.basename(f))] for name in wanted}
    if missing := [n for n, folders in of.items() if not folders]:
        raise ValueError(f"not finished: {', '.join(missing)}")
    return {f: kept[f] for folders in of.values() for f in folders}, skipped


def single_finished(root: str, source: str | None = None) -> str:
    """The folder of the only finished run; an error where there is none, or more than one."""
    found = list(find_finished(root, source))
    if len(found) != 1:
        raise ValueError(f"{len(found)} finished runs under {root}")
    return found[0]


def sweep(stages: Sequence[tuple[str, Callable[[], bool]]]) -> list[str]:
    """Run stages one after the other; the first that isn't whole stops the sweep.  The names of those that were."""
    done = []
    for name, run in stages:
        if not run():
            raise ValueError(f"{name} is partial; nothing after it was run")
        done.append(name)
    return done


def in_parallel(jobs: dict[str, Callable[[], object]], at_once: int = 4) -> tuple[dict[str, object], dict[str, str]]:
    """(results, failures) of jobs on the driver's threads, each a Spark job of its own; a failure is reported and stops no other."""
    results, failed = {}, {}
    with ThreadPoolExecutor(at_once) as pool:
        for name, future in {n: pool.submit(job) for n, job in jobs.items()}.items():
            try:
                results[name] = future.result()
            except Exception as e:  # noqa: BLE001 - whatever ends a job is its report
                failed[name] = str(e)
    return results, failed
