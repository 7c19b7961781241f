"""The request key is that of the JSON other libraries write, whatever the size of a number."""

import hashlib
import json

from creditlens.functions import scoring


def test_numbers_print_as_in_json(spark):
    numbers = [1e7, -12345678.5, 9999999.0, 123456789012345.25, 9007199254740993.0, 1e16, -2.5e17, 0.0, 0.001, 0.0001, -0.00012345, 1.5e-5, 0.1, 1e100, None]
    rows = [(i, x, text) for i, x in enumerate(numbers) for text in ("a", 'x":1.0E7,', None)]
    found = spark.createDataFrame(rows, "n int, x double, text string").select("*", scoring.request_key(["x", "text", "n"]).alias("key")).collect()
    for row in found:
        body = json.dumps({"n": row["n"], "text": row["text"], "x": row["x"]}, separators=(",", ":"))
        assert row["key"] == hashlib.md5(body.encode()).hexdigest(), body
