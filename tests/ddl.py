"""Schemas from short texts, without a session."""

import re

from pyspark.sql import types as T

KINDS = {"bigint": T.LongType, "int": T.IntegerType, "string": T.StringType, "double": T.DoubleType, "date": T.DateType, "timestamp": T.TimestampType}


def schema(text: str) -> T.StructType:
    fields = []
    for name, kind in re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", text):
        digits = re.findall(r"\d+", kind) if kind.startswith("decimal") else None
        fields.append(T.StructField(name, T.DecimalType(*map(int, digits)) if digits else KINDS[kind]()))
    return T.StructType(fields)
