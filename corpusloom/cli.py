"""python -m corpusloom.cli COMMAND: list, show, search, stats, parse, mix, split, dedup and mixture on files.

0: done, 1: failed, 2: wrong use, 3: a mixture that can't be met."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import read_config
from .functions.text import normal_text
from .operators import dedup, explore, manifest, mix, normalize, parse, sampling
from .session import session
from .sources.readers import load, with_ordinal
from .sources.sinks import as_markdown, as_text, write_conformed, write_jsonl

#: Statuses besides 0, 1 and argparse's 2.
UNSATISFIABLE = 3


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    sub = p.add_subparsers(dest="command", required=True)
    on_file = {}
    for name in ("list", "show", "search", "stats", "parse", "split", "dedup"):
        on_file[name] = sub.add_parser(name)
        on_file[name].add_argument("path")
    for name in ("list", "parse"):
        on_file[name].add_argument("--has-tools", action="store_true")
    on_file["list"].add_argument("-n", "--limit", type=int)
    on_file["list"].add_argument("--has-reasoning", action="store_true")
    on_file["list"].add_argument("--min-messages", type=int)
    on_file["show"].add_argument("index", type=int)
    on_file["show"].add_argument("--field", help="one column, or a path into it")
    on_file["show"].add_argument("--format", choices=("json", "markdown", "text"), default="json")
    on_file["search"].add_argument("query")
    on_file["search"].add_argument("--field", action="append", help="look into these columns alone")
    on_file["search"].add_argument("-n", "--limit", type=int, default=20)
    on_file["search"].add_argument("--case-sensitive", action="store_true")
    c = on_file["parse"]
    c.add_argument("-o", "--output")
    c.add_argument("--format", choices=("json", "jsonl", "markdown", "text"), default="jsonl")
    c.add_argument("--compact", action="store_true")
    c.add_argument("--index", type=int)
    c.add_argument("--start", type=int)
    c.add_argument("--end", type=int)
    c = on_file["split"]
    c.add_argument("-o", "--output", required=True)
    c.add_argument("-n", "--parts", type=int, required=True)
    c.add_argument("--shuffle", action="store_true")
    c.add_argument("--seed", type=int, default=0)
    c = on_file["dedup"]
    c.add_argument("--text", default="text")
    c.add_argument("--mode", choices=("dry-run", "normalize", "exact", "plan", "minhash"), default="exact")
    c.add_argument("-o", "--output")
    c = sub.add_parser("mix")
    c.add_argument("path")
    c.add_argument("-o", "--output")
    c.add_argument("--include", nargs="*", default=[])
    c.add_argument("--exclude", nargs="*", default=[])
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--sample-source")
    c.add_argument("--sample-rate", type=float, default=1.0)
    c.add_argument("--sample-seed", type=int, default=0)
    c.add_argument("--shuffle", action="store_true")
    c.add_argument("--shuffle-seed", type=int, default=0)
    c.add_argument("--num-chunks", type=int)
    c.add_argument("--resume", action="store_true", help="do nothing where the output is finished")
    c = sub.add_parser("mixture")
    c.add_argument("config", help="the target mixture, YAML or JSON")
    c.add_argument("manifest", help="capacity, Parquet: len_bucket, domain, subdomain, n_tokens")
    c.add_argument("--budget", type=int)
    return p


def _mix(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.output and a.resume and os.path.exists(os.path.join(a.output, "_SUCCESS")):
        return 0
    df = mix.mix(spark, a.path, a.include, a.exclude)
    if a.sample_source:
        keyed = df.withColumn("__row", F.sha2(F.to_json(F.struct(*df.columns)), 256))
        df = mix.sample_source(keyed, a.sample_source, a.sample_rate, "__row", a.sample_seed).drop("__row")
    if a.dry_run or not a.output:
        mix.dry_run(df).show(1000, False)
        return 0
    schema = df.schema
    if a.shuffle:
        df = sampling.shuffled(df.withColumn("__row", F.sha2(F.to_json(F.struct(*df.columns)), 256)), "__row", a.shuffle_seed).drop("__row")
    elif a.num_chunks:
        df = df.repartition(a.num_chunks)
    write_conformed(df, a.output, schema, mode="overwrite" if a.resume else "error")
    return 0


def _dedup(df: DataFrame, a: argparse.Namespace) -> None:
    text = normal_text(F.col(a.text))
    if a.mode == "dry-run":
        print(json.dumps(normalize.inspect(df, normalize.Source(os.path.basename(a.path)))))
        return
    if a.mode in ("exact", "plan"):
        dedup.exact_report(df, text).show()
        if a.mode == "plan" or not a.output:
            return
    if not a.output:
        raise ValueError(f"{a.mode} needs an output")
    if a.mode == "normalize":
        normalize.to_pretraining(df, normalize.Source(os.path.basename(a.path))).write.parquet(a.output)
        return
    rows = with_ordinal(df)
    if a.mode == "exact":
        kept = dedup.survivors(rows, "ordinal", text)
    else:
        kept = dedup.near_duplicates(rows, "ordinal", a.text).where("keep").select("ordinal")
    rows.join(kept, "ordinal", "left_semi").drop("ordinal").write.parquet(a.output)


def _show(rows: DataFrame, form: str, output: str | None, compact: bool = True) -> None:
    """Records as JSON lines, one JSON value (an object, or an array of several), Markdown or text: to a file, or printed."""
    if form in ("markdown", "text"):
        said = as_markdown(F.col("messages"), F.col("uuid")) if form == "markdown" else as_text(F.col("messages"))
        rows.select(said.alias("value")).write.text(output) if output else print("\n\n".join(r[0] or "" for r in rows.select(said).toLocalIterator()))
        return
    if form == "jsonl":
        write_jsonl(rows, output) if output else [print(x) for x in rows.toJSON().toLocalIterator()]
        return
    found = [json.loads(x) for x in rows.toJSON().collect()]  # the records asked for, as one value
    text = json.dumps(found[0] if len(found) == 1 else found, ensure_ascii=False, indent=None if compact else 2)
    if output:
        with open(output, "w", encoding="utf-8") as f:
            f.write(text)
    else:
        print(text)


def _mixture(spark: SparkSession, a: argparse.Namespace) -> int:
    checked = manifest.check_mixture(spark.read.parquet(a.manifest), manifest.parse_mixture(read_config(a.config)), a.budget)
    checked.orderBy("len_bucket", "domain", "subdomain").show(1000, False)
    return 0 if manifest.satisfiable(checked) else UNSATISFIABLE


def _run(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.command == "mix":
        return _mix(spark, a)
    if a.command == "mixture":
        return _mixture(spark, a)
    df = load(spark, a.path)
    if a.command == "dedup":
        _dedup(df, a)
    elif a.command == "search":
        explore.search(df, a.query, a.field, case_sensitive=a.case_sensitive).limit(a.limit).select("found_in", "around").show(a.limit, False)
    elif a.command == "show":
        row = with_ordinal(df).where(F.col("ordinal") == a.index)
        _show(row.select(a.field) if a.field else row if a.format == "json" else explore.with_defaults(row), "jsonl" if a.format == "json" else a.format, None)
    elif a.command == "split":
        rows = with_ordinal(df)
        parts = sampling.shuffled_parts(rows, "ordinal", a.parts, a.seed) if a.shuffle else sampling.with_part(rows, a.parts, "ordinal")
        parts.drop("ordinal").write.partitionBy("part").parquet(a.output)
    else:
        rows = with_ordinal(explore.with_defaults(df))
        if a.command == "list":
            explore.summary(explore.list_records(rows, a.has_tools, a.has_reasoning, a.min_messages, a.limit), "ordinal").show(a.limit or 1000, False)
        elif a.command == "stats":
            explore.statistics(rows).show()
            explore.role_counts(rows).show()
        else:
            chosen = parse.select_records(rows, "ordinal", a.index, a.start, a.end, a.has_tools)
            _show(parse.prompts(chosen), a.format, a.output, a.compact)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    try:
        return _run(session(), a)
    except (ValueError, IndexError, FileNotFoundError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
