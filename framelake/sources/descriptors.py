"""Descriptor-set loading (SRC-4).

A descriptor set is one small file (what ``buf build --as-file-descriptor-set``
writes). It is read through Spark's ``binaryFile`` source, so local paths,
``s3a://`` and any other Hadoop file system work the same way, with no copy to
a machine-local temporary file. The bytes are handed to the decoder directly.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def normalize_path(path: str) -> str:
    """``s3://`` is read through the S3A file system; blank stays blank."""
    p = (path or "").strip()
    if p.startswith("s3://"):
        p = "s3a://" + p[len("s3://") :]
    return p


def load_descriptor_set(spark: SparkSession, path: str) -> bytes:
    """Bytes of the serialized FileDescriptorSet at ``path``."""
    p = normalize_path(path)
    if not p:
        raise ValueError("no descriptor set path given")
    files = spark.read.format("binaryFile").load(p)
    found = files.count()  # metadata only
    if found != 1:
        raise ValueError(f"expected one descriptor set file at {p}, found {found}")
    return bytes(files.select(F.col("content")).first()[0])


def save_descriptor_set(spark: SparkSession, path: str, descriptor_set: bytes) -> None:
    """Write a descriptor set as one file through Hadoop's file systems, where
    ``load_descriptor_set`` of any machine finds it. Replaces an earlier one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(descriptor_set))
    finally:
        out.close()
