"""prelaunch: pre-launch success analytics on Spark DataFrames.

Profiling, cohort definition, feature engineering, temporal splits,
Spark ML models and evaluation, every step a distributed DataFrame plan.
"""

__version__ = "0.1.0"
