"""What the JSON records of a company were seen to hold: kept beside the entity, added to file by file.

An observation is a list of increments. Each has the files it was made from, by path, length and
time of change, the type their values have together, and the most digits of its wide numbers. A
reader lists the files, drops increments of which a file has changed or gone, and looks at the records
of the files that are left over. Increments merge into the schema that one pass over all files
would give, so a new file costs a pass over itself. The list is published like a landing: a file
under the next number, which appears whole or not at all; the last ``KEPT`` stay. It only saves work: where another reader was
faster, or the folder takes no files, the next reader looks again.
"""

from __future__ import annotations

import json
import re
import uuid
import warnings
from dataclasses import dataclass, field, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.operators import infer
from entityframe.sources import log

OBSERVED = "_observed"
KEPT = 8  # versions, for readers that have listed them and not read them yet
Print = tuple[str, int, int]  # path, length, time of change in microseconds


@dataclass(frozen=True)
class Increment:
    files: frozenset[Print]
    observed: T.DataType
    digits: dict[infer.Steps, infer.Digits] = field(default_factory=dict)

    def to_json(self) -> dict:
        return {
            "files": sorted(self.files),
            "observed": json.loads(T.StructType([T.StructField("record", self.observed)]).json()),
            "digits": [[list(path), *most] for path, most in self.digits.items()],
        }

    @classmethod
    def from_json(cls, found: dict) -> "Increment":
        return cls(
            frozenset((path, length, time) for path, length, time in found["files"]),
            T.StructType.fromJson(found["observed"]).fields[0].dataType,
            {tuple(path): infer.Digits(*most) for path, *most in found["digits"]},
        )


def file_prints(spark: SparkSession, path: str) -> frozenset[Print]:
    """The files below ``path`` as Spark lists them; their contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("path", "length", F.unix_micros("modificationTime"))
    return frozenset(tuple(row) for row in found.collect())


def merged(increments: list[Increment]) -> Increment:
    """One increment of all files; digits are kept of fields that every increment with numbers there knows."""
    paths = {path for one in increments for path in one.digits}
    digits = {
        path: infer.Digits(*map(max, zip(*(one.digits[path] for one in increments if path in one.digits))))
        for path in paths
        if not any(_lacks(one, path) for one in increments)
    }
    return Increment(
        frozenset().union(*(one.files for one in increments)),
        reduce(infer.merge_observed, (one.observed for one in increments), T.NullType()),
        digits,
    )


def _lacks(one: Increment, path: infer.Steps) -> bool:
    """Whether the increment has numbers at the path whose digits were not looked at."""
    dtype = one.observed
    for step in path:
        if step is None and isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        elif step is not None and isinstance(dtype, T.StructType) and step in dtype.names:
            dtype = dtype[step].dataType
        else:
            # Values of different kinds: there may be records with numbers there.
            return isinstance(dtype, T.VariantType) and path not in one.digits
    return not isinstance(dtype, (T.NullType, T.StringType, T.BooleanType)) and path not in one.digits


class Observations:
    """The increments of one company's JSON files, in its environment."""

    def __init__(self, spark: SparkSession, base: str, where: str, skip_unreadable: bool):
        self._spark, self._where, self._skip = spark, where, skip_unreadable
        self._files = log.Files(spark, base)
        kind = "readable" if skip_unreadable else "all"
        self._folder = f"{base}/{OBSERVED}{where[len(base):]}/lines={kind}"

    def _latest(self) -> tuple[int, list[Increment]]:
        names = self._files.names(f"{self._folder}/*.json")
        if not names:
            return 0, []
        try:
            found = json.loads(self._files.read(names[-1]))
        except Py4JJavaError as error:
            if "FileNotFound" not in str(error.java_exception):
                raise
            return self._latest()  # removed since it was listed, so there are later ones
        return found["version"], [Increment.from_json(one) for one in found["increments"]]

    def _publish(self, version: int, increments: list[Increment]) -> None:
        text = {"version": version, "landing": uuid.uuid4().hex, "increments": [one.to_json() for one in increments]}
        try:
            self._files.publish(f"{self._folder}/{log.entry_name(version)}", json.dumps(text))
            for name in self._files.names(f"{self._folder}/*.json")[:-KEPT]:
                self._files.remove(name)
        except log.LandingConflict:
            pass  # what another reader has seen will do as well
        except Py4JJavaError as error:
            warnings.warn(f"what the records hold is not kept: {error.java_exception}", stacklevel=2)

    def _lines(self, files: frozenset[Print], everything: bool) -> DataFrame:
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path, _, _ in sorted(files)]
        lines = self._spark.read.text(self._where if everything else paths)
        return lines.where(F.trim("value") != "")

    def schema(self, on_conflict: str, decimals: bool) -> T.StructType:
        """The schema of all records, from what is known and a pass over the files that are not."""
        files = file_prints(self._spark, self._where)
        version, known = self._latest()
        counted = [one for one in known if one.files <= files]
        new = files.difference(*(one.files for one in counted))
        if new:
            lines = self._lines(new, everything=not counted)
            counted.append(Increment(new, infer.observe(lines, "value", self._skip)))
        whole = merged(counted)
        wide = [] if decimals else [p for p in infer.wide_numbers(whole.observed, "string") if infer.addressable(p)]
        lacking = [one for one in counted if any(_lacks(one, path) for path in wide)]
        if lacking:
            # These are looked at in one pass, and are one increment from then on.
            again = merged(lacking)
            lines = self._lines(again.files, everything=again.files == files)
            with infer.by_case(lines):
                most = infer.most_digits(lines, "value", wide, self._skip)
            counted = [one for one in counted if one not in lacking] + [replace(again, digits=again.digits | most)]
            whole = merged(counted)
        if new or lacking or len(counted) < len(known):
            self._publish(version + 1, counted)
        digits = {path: whole.digits[path] for path in wide if path in whole.digits}
        both = self._spark.conf.get("spark.sql.caseSensitive") == "true"
        return infer.record_schema(whole.observed, on_conflict, decimals, digits, both)
