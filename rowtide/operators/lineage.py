"""Cut a plan where its result is read more than once or must outlive an executor."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowtide.session import shared_dir


def settle(df: DataFrame) -> DataFrame:
    """``df`` written once to the cluster's checkpoint folder and read from there.

    Used for frames far smaller than their input, such as one row per response.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
