"""Files of the corpus: CSV tables, word lists, rule files, batch outputs, logs."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.sources.pairs import require_columns


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """String columns of a quoted CSV file with header; a byte order mark and
    line breaks in quotes are fine, other columns are left out."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    require_columns(df, columns)
    return df.select(*(F.col(f"`{c}`") for c in columns))


def read_words(path: str) -> list[str]:
    """Words of a list, one a line; # begins a comment.  Repeated words and empty lists are errors."""
    lines = Path(path).read_text(encoding="utf-8-sig").splitlines()
    words = [w for w in (line.strip() for line in lines) if w and not w.startswith("#")]
    if not words:
        raise ValueError(f"{path}: no words")
    if len(set(words)) != len(words):
        raise ValueError(f"{path}: repeated words")
    return words


def read_rules(path: str) -> dict:
    """A JSON object of rules."""
    rules = json.loads(Path(path).read_text(encoding="utf-8-sig"))
    if not isinstance(rules, dict):
        raise ValueError(f"{path}: not an object")
    return rules


#: What a pattern of the rules writes otherwise than the JVM reads it.
_OTHER_SYNTAX = ((r"(?P<", "(?<"), (r"\Z", r"\z"))


def jvm_pattern(pattern: str) -> str:
    """A pattern of a rule file as the JVM reads it; what cannot be said there is an error.

    Named groups and the end anchor are written otherwise, named references and
    conditions are refused, and the pattern must be well formed on this side.
    """
    import re

    re.compile(pattern)
    if re.search(r"\(\?P[=>]|\(\?\(", pattern):
        raise ValueError(f"no JVM form of {pattern!r}")
    for old, new in _OTHER_SYNTAX:
        pattern = pattern.replace(old, new)
    return pattern


def read_patterns(path: str, key: str = "patterns") -> dict[str, str]:
    """The named patterns of a rule file, each checked and translated once."""
    found = read_rules(path).get(key)
    if not isinstance(found, dict) or not all(isinstance(v, str) for v in found.values()):
        raise ValueError(f"{path}: {key} is no object of patterns")
    return {name: jvm_pattern(pattern) for name, pattern in found.items()}


def read_lexicons(folder: str, names: dict[str, str]) -> dict[str, tuple[str, ...]]:
    """Word lists of a folder by file; a file that is not there keeps the built-in list of that name.

    ``names`` maps files to names in :mod:`loomline.functions.lexicons`.  Suffixes
    come longest first, as the first one that fits is taken.
    """
    from loomline.functions import lexicons

    out = {}
    for file, name in names.items():
        path = Path(folder) / file
        words = tuple(read_words(str(path))) if path.exists() else getattr(lexicons, name)
        out[name] = tuple(sorted(words, key=lambda w: -len(w))) if "SUFFIXES" in name else words
    return out


def read_manifest(path: str, required: tuple[str, ...] = ()) -> dict:
    """A JSON manifest; a required entry that is missing or no filled text is an error."""
    manifest = read_rules(path)
    for name in required:
        if not isinstance(manifest.get(name), str) or not manifest[name].strip():
            raise ValueError(f"{path}: {name} is missing")
    return manifest


def manifest_path(path: str, manifest: dict, name: str) -> Path:
    """A path that a manifest names; relative ones count from the manifest's folder."""
    found = Path(manifest[name])
    return found if found.is_absolute() else Path(path).resolve().parent / found


def list_checkpoints(folder: str, prefix: str = "checkpoint-") -> list[Path]:
    """Checkpoint folders in the order of their steps; other entries are left out."""
    found = [p for p in Path(folder).iterdir() if p.is_dir() and p.name.startswith(prefix) and p.name[len(prefix) :].isdigit()]
    return sorted(found, key=lambda p: int(p.name[len(prefix) :]))


def latest_checkpoint(folder: str, prefix: str = "checkpoint-") -> Path | None:
    """The checkpoint of the last step, or None."""
    found = list_checkpoints(folder, prefix)
    return found[-1] if found else None


BATCH_OUTPUT = T.StructType([
    T.StructField("custom_id", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("response", T.StructType([T.StructField("body", T.StructType([
        T.StructField("choices", T.ArrayType(T.StructType([
            T.StructField("finish_reason", T.StringType()), T.StructField("message", T.StructType([T.StructField("content", T.StringType())])),
        ]))),
        T.StructField("usage", T.StructType([T.StructField(c, T.LongType()) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])),
    ]))])),
])


def read_batch_output(spark: SparkSession, path: str) -> DataFrame:
    """(custom_id, error, finish_reason, content, tokens) of a JSONL file of responses.

    A missing or repeated ``custom_id`` is an error while the query runs.
    """
    parsed = spark.read.text(path).where("trim(value) <> ''").select(F.from_json("value", BATCH_OUTPUT).alias("r")).select("r.*")
    first = F.get("response.body.choices", F.lit(0))
    rows = parsed.select(
        "custom_id", "error", first["finish_reason"].alias("finish_reason"), first["message"]["content"].alias("content"), F.col("response.body.usage").alias("usage")
    )
    times = rows.groupBy(F.col("custom_id").alias("__id")).agg(F.count("*").alias("__n"))
    joined = rows.join(times, F.col("custom_id").eqNullSafe(F.col("__id"))).drop("__id")
    bad = F.col("custom_id").isNull() | (F.col("__n") > 1)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("missing or repeated custom_id: "), F.coalesce("custom_id", F.lit("none"))))).otherwise(F.col("custom_id"))
    return joined.withColumn("custom_id", checked).drop("__n")


def token_usage(responses: DataFrame) -> DataFrame:
    """Sums of the token counts of all responses."""
    return responses.agg(*(F.coalesce(F.sum(f"usage.{c}"), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")))


def read_log_history(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(step, epoch, columns) of the ``log_history`` list in a trainer's state; ``step`` is the entry's place."""
    entry = T.StructType([T.StructField(c, T.DoubleType()) for c in ("epoch", *columns)])
    state = spark.read.schema(T.StructType([T.StructField("log_history", T.ArrayType(entry))])).json(path, multiLine=True)
    return state.select(F.posexplode("log_history").alias("step", "e")).select("step", "e.*")


def content_hash(path: str) -> str:
    """SHA-256 of a file in upper-case hexadecimal digits."""
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest().upper()


def require_hash(path: str, expected: str) -> None:
    """Raises where a file is not the one that was read before."""
    if content_hash(path) != expected.upper():
        raise ValueError(f"{path} changed since it was read")
