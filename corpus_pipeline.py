"""The corpus pipeline, as a driver finds it: STAGES, ORACLE_SQL and run(spark, sf_dir) of quireflow.llm.pipeline."""

from quireflow.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
