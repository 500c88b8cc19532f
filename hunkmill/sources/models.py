"""Model files: configuration, tokenizer, safetensors shards and adapters."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import workspace
from hunkmill.sources.forge import Folder

CONFIG_FIELDS = {
    "hidden_size": "int", "num_hidden_layers": "int", "num_attention_heads": "int", "num_key_value_heads": "int", "head_dim": "int",
    "intermediate_size": "int", "vocab_size": "int", "full_attention_interval": "int", "linear_num_key_heads": "int",
    "linear_num_value_heads": "int", "linear_key_head_dim": "int", "linear_value_head_dim": "int", "linear_conv_kernel_dim": "int", "rms_norm_eps": "double",
}
# What a configuration without these fields means.
DEFAULTS = {"full_attention_interval": 4, "linear_conv_kernel_dim": 4, "rms_norm_eps": 1e-6}
ROPE_DEFAULTS = {"rope_theta": 10_000_000.0, "partial_rotary_factor": 0.25}


def config(text: Column) -> Column:
    """struct of the configuration's fields: those of ``text_config``, else the top level's, else the defaults.

    The rotary fields may stand in ``rope_parameters``.
    """
    fields = ", ".join(f"{k}: {v}" for k, v in CONFIG_FIELDS.items())
    rope = "rope_theta: double, partial_rotary_factor: double"
    level = f"{fields}, {rope}, rope_parameters: struct<{rope}>"
    parsed = F.from_json(text, f"struct<{level}, text_config: struct<{level}>>")
    inner, outer = parsed["text_config"], parsed
    plain = [
        F.coalesce(inner[k], outer[k], F.lit(DEFAULTS[k]).cast(t) if k in DEFAULTS else F.lit(None).cast(t)).alias(k) for k, t in CONFIG_FIELDS.items()
    ]
    rotary = [
        F.coalesce(inner["rope_parameters"][k], inner[k], outer["rope_parameters"][k], outer[k], F.lit(d)).alias(k) for k, d in ROPE_DEFAULTS.items()
    ]
    return F.struct(*plain, *rotary)


def is_full_attention(layer: Column, interval: Column) -> Column:
    """Whether a layer (from 0) attends in full."""
    return F.pmod(layer + 1, interval) == 0


def is_multimodal(config_text: Column) -> Column:
    """By the architectures' names or by the sections of a configuration."""
    return config_text.rlike(r"\"(?:vision_config|audio_config)\"") | config_text.rlike(r"\"architectures\"\s*:\s*\[[^\]]*(?:ConditionalGeneration|ImageTextToText|Vision)")


def adapted(name: Column, layers: tuple[str, ...] = ("q_proj", "k_proj", "v_proj", "o_proj", "gate_proj", "up_proj", "down_proj", "in_proj_qkv", "in_proj_z", "out_proj")) -> Column:
    """Whether a weight takes a low-rank adapter: a layer's projection matrix."""
    kinds = "|".join(layers)
    return name.startswith("model.") & name.endswith(".weight") & name.rlike(rf"\.layers\.[0-9]+\..*\b(?:{kinds})\.weight$")


def adapter_keys(name: Column) -> tuple[Column, Column]:
    """Names of the A and B matrices that belong to a weight."""
    stem = F.concat(F.lit("base_model.model."), F.regexp_replace(name, r"\.weight$", ""))
    return F.concat(stem, F.lit(".lora_A.weight")), F.concat(stem, F.lit(".lora_B.weight"))


def pair_adapters(weights: DataFrame, adapters: DataFrame) -> DataFrame:
    """(name, w, a, b) of the weights (name, tensor) that have both matrices among the adapters (name, tensor)."""
    key_a, key_b = adapter_keys(F.col("name"))
    keyed = weights.select("name", F.col("tensor").alias("w"), key_a.alias("key_a"), key_b.alias("key_b"))
    a, b = adapters.toDF("key_a", "a"), adapters.toDF("key_b", "b")
    return keyed.join(a, "key_a").join(b, "key_b").select("name", "w", "a", "b")


KINDS = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4", "U32": "<u4", "U8": "u1"}


def decode(content: bytes, dtype: str) -> np.ndarray:
    """The numbers of one tensor's bytes."""
    if dtype == "BF16":
        return (np.frombuffer(content, "<u2").astype("<u4") << 16).view("<f4")
    return np.frombuffer(content, KINDS[dtype])


def entries(header: bytes, size: int, prefix: str = "") -> Iterator[tuple[str, list[int], str, int, int]]:
    """(name, shape, dtype, first byte, number of bytes) of the tensors whose names start with the prefix, by a file's header."""
    listed = json.loads(header)
    for name in sorted(listed):
        if name != "__metadata__" and name.startswith(prefix):
            entry = listed[name]
            first, end = entry["data_offsets"]
            yield name, entry["shape"], entry["dtype"], 8 + size + first, end - first


def write_tensors(tensors: dict[str, np.ndarray]) -> bytes:
    """A safetensors file of single-precision tensors, names sorted."""
    header, blobs, at = {}, [], 0
    for name in sorted(tensors):
        blob = np.ascontiguousarray(tensors[name], "<f4").tobytes()
        header[name] = {"dtype": "F32", "shape": list(tensors[name].shape), "data_offsets": [at, at + len(blob)]}
        blobs.append(blob)
        at += len(blob)
    text = json.dumps(header).encode()
    text += b" " * (-len(text) % 8)
    return struct.pack("<Q", len(text)) + text + b"".join(blobs)


PLACED = "path string, name string, shape array<int>, dtype string, first bigint, bytes bigint"


def list_tensors(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(path, name, shape, dtype, first, bytes) of all tensors in the ``*.safetensors`` shards of a folder: only headers are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.safetensors").load(folder).select("path")

    def headers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame["path"]:
                with _opened(path) as f:
                    (size,) = struct.unpack("<Q", f.read(8))
                    rows += [(path, *entry) for entry in entries(f.read(size), size, prefix)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PLACED.split(", ")])

    return files.mapInPandas(headers, PLACED)


def scan_tensors(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(name, shape, tensor) of the tensors whose names start with the prefix.

    The names are chosen by the shards' headers; then the tensors are spread over the tasks, and each reads
    its own ranges of bytes, so neither a shard's size nor other tensors matter.  Dense single precision.
    """
    placed = workspace.keep(list_tensors(spark, folder, prefix), "tensors")
    tasks = max(1, min(placed.count(), 4 * spark.sparkContext.defaultParallelism))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for t in frame.itertuples():  # one tensor at a time is in memory
                with _opened(t.path) as f:
                    f.seek(t.first)
                    numbers = decode(f.read(t.bytes), t.dtype).astype("f4")
                yield pd.DataFrame({"name": [t.name], "shape": [t.shape], "tensor": [numbers]})

    return placed.repartition(tasks, "path", "first").mapInPandas(read, "name string, shape array<int>, tensor array<float>")


def _opened(path: str):
    """A file that can be read from any place on, wherever pyarrow finds it."""
    fs, name = arrow_fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.open_input_file(name)


# The fields of an adapter's configuration that loaders read.
ADAPTER_CONFIG = {"peft_type": "LORA", "auto_mapping": None, "lora_dropout": 0.0, "bias": "none", "task_type": "CAUSAL_LM", "inference_mode": True}


def adapter_config(names: list[str], base: str, rank: int, alpha: float) -> dict:
    """The configuration beside an adapter's matrices: what it adapts, by the last part of the weights' names."""
    stems = [n.removesuffix(".weight").removesuffix(".lora_A").removesuffix(".lora_B") for n in names]
    return ADAPTER_CONFIG | {"base_model_name_or_path": base, "r": rank, "lora_alpha": alpha, "target_modules": sorted({s.rsplit(".", 1)[-1] for s in stems})}


def save_adapter(folder: str, layers: dict[str, tuple[np.ndarray, np.ndarray]], base: str, alpha: float) -> None:
    """``adapter_model.safetensors`` and ``adapter_config.json`` of the matrices A and B by the weights they belong to."""
    tensors, rank = {}, 0
    for weight, (a, b) in layers.items():
        stem = f"base_model.model.{weight.removesuffix('.weight')}"
        tensors |= {f"{stem}.lora_A.weight": a, f"{stem}.lora_B.weight": b}
        rank = a.shape[0]
    target = Folder(folder)
    target.write("adapter_model.safetensors", write_tensors(tensors))
    target.write("adapter_config.json", json.dumps(adapter_config(list(tensors), base, rank, alpha), indent=2).encode())


def tokenizer_columns(texts: Column, path: str) -> Column:
    """Token ids by a ``tokenizer.json``, as an Arrow batch function; null texts give null."""
    with open(path) as f:
        definition = f.read()

    @F.pandas_udf("array<int>")  # type: ignore[call-overload]
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(definition)
        made.encode_special_tokens = True
        for batch in batches:
            encoded = made.encode_batch([t or "" for t in batch], add_special_tokens=False)
            yield pd.Series([None if t is None else e.ids for t, e in zip(batch, encoded, strict=True)], dtype=object)

    return ids(texts)
