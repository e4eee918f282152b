"""subsight: subscription analytics on Spark.

Bronze -> silver -> gold layers and named business queries over the marts,
as DataFrame plans (no UDFs, no driver-side loops). See README.md.

    from subsight import Lake, LakeConfig, QUERIES, run_pipeline
    config = LakeConfig(schema="analytics")
    run_pipeline(spark, config)
    QUERIES["silent_member_count"](Lake.from_catalog(spark, config)).show()
"""

__version__ = "0.1.0"

from subsight.lake import Lake  # noqa: E402
from subsight.plans.pipeline import refresh_months, run_gold, run_pipeline, run_silver  # noqa: E402
from subsight.plans.registry import QUERIES  # noqa: E402
from subsight.sources.catalog import LakeConfig  # noqa: E402

__all__ = ["Lake", "LakeConfig", "QUERIES", "run_pipeline", "run_silver", "run_gold", "refresh_months"]
