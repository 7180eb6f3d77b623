"""The publishers' standard GPL notice gets its exact label."""

import pytest

from chalkline.llm import licenses

NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
          "Public License as published by the Free Software Foundation, either version {} of the License, or (at your "
          "option) any later version.")


@pytest.mark.parametrize("version", [2, 3])
def test_standard_notice(spark, version):
    df = spark.createDataFrame([(NOTICE.format(version),), (NOTICE.format(4),)], "text string")
    found, other = (r["_license"] for r in licenses.scan(df).collect())
    assert {m["label"] for m in found["matches"]} == {"gpl", f"gpl-{version}.0"}
    words = licenses.words_of(NOTICE.format(version))
    assert found["n_covered"] == len(words) - words.index(b"under")
    assert {m["label"] for m in other["matches"]} == {"gpl"}
