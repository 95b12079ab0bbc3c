"""Make this package importable in Python workers, however the driver found it."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import SparkSession

import navspark
from navspark.session import ensure_checkpoint_dir


def package_archive() -> bytes:
    """The package's modules as a zip archive."""
    root = os.path.dirname(os.path.abspath(navspark.__file__))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("navspark", os.path.relpath(full, root)))
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors once per application (``--py-files`` in code).

    The archive goes through Hadoop's file system API into the shared
    checkpoint folder, where every executor, also a late or replaced one,
    finds it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_navspark_shipped", False):
        return
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/package-{uuid.uuid4().hex}/navspark.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(package_archive()))
    finally:
        stream.close()
    sc.addPyFile(path)
    sc._navspark_shipped = True
