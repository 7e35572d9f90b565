"""lathe: tabular profiling, feature fitting and scoring as Spark DataFrame jobs.

Every operator takes and returns a :class:`pyspark.sql.DataFrame` (or a small
fitted-state object whose statistics were computed by Spark aggregations).
Nothing pulls table rows to the driver; only per-column statistics of a bounded
size (one row, or one row per column/bucket) ever leave the executors.

Most used entry points::

    from lathe import get_spark, read_table
    from lathe.operators.stats import Winsorizer, RobustScaler
    from lathe.operators.ranks import quantiles, kfold, sample_n, avg_rank_column
    from lathe.operators.profile import profile_table, eda_summary, spearman_matrix
    from lathe.operators.metrics import roc_auc, rmse
    from lathe.plans.audio import fit_audio_v2
"""

from lathe.session import get_spark, checkpoint_dir, scratch_path
from lathe.sources.files import read_table, read_parquet, read_table_csv, nan_to_null

__all__ = ["get_spark", "checkpoint_dir", "scratch_path", "read_table", "read_parquet", "read_table_csv",
           "nan_to_null"]
