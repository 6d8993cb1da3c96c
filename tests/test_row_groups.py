"""A stretch of a segment does not read the whole segment."""

import glob

import pyarrow.parquet as pq
from builders import frame, message

from tidegate.sources import stored


def test_segments_have_small_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "GROUP_ROWS", 200)
    rows = [message("0", i, hub="h", seconds=i) for i in range(1000)]
    stored.store_hub(frame(spark, rows), str(tmp_path / "hub"))
    files = glob.glob(f"{tmp_path}/hub/data/**/*.parquet", recursive=True)
    sizes = [pq.ParquetFile(f).metadata.row_group(i).num_rows for f in files
             for i in range(pq.ParquetFile(f).num_row_groups)]
    assert sum(sizes) == 1000 and max(sizes) <= 300
