from __future__ import annotations

from pathlib import Path

from heliovane.llm.common import noted_scratch, remove_paths, stored


def test_stored_writes_no_checksum_files(spark):
    """Each of them started processes of its own, which show an executor's whole memory for an instant."""
    given = spark.range(0, 1_000, 1, 3).selectExpr("id", "if(id % 7 = 0, null, concat('ä', id)) as text")
    with noted_scratch() as paths:
        out = stored(given, "plain")
    folder = Path(paths[0].removeprefix("file:"))
    names = [file.name for file in folder.iterdir()]
    assert sum(name.endswith(".parquet") for name in names) == 3 and "_SUCCESS" in names
    assert not [name for name in names if name.endswith(".crc")]
    assert out.dtypes == given.dtypes and out.orderBy("id").collect() == given.orderBy("id").collect()
    # Other tables keep theirs.
    given.write.parquet(f"{folder}-other")
    assert any(file.name.endswith(".crc") for file in Path(f"{folder}-other").iterdir())
    remove_paths(spark, paths)
    assert not folder.exists()
