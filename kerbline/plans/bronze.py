"""Bronze: rows as delivered, plus where and when they were loaded."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stamp_load(df: DataFrame, source_name: str, batch_id: str | Column, source_file: str | Column | None = None) -> DataFrame:
    """Add load time, source name, batch id and source file.

    A batch id that is a column stamps several batches at once. `source_file` may be left out when the scan already carries that column. The
    batch id is passed in, so a run can be repeated under the same one.
    """
    stamps = {
        "ingestion_timestamp": F.current_timestamp(),
        "source_name": F.lit(source_name),
        "batch_id": F.lit(batch_id),
    }
    if source_file is not None:
        stamps["source_file"] = F.lit(source_file)
    return df.withColumns(stamps)
