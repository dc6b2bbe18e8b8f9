"""cirflow: waveform feature engineering, splitting, profiling, model training
and evaluation expressed as Spark DataFrame plans.

Every public operator takes DataFrames / Columns and returns DataFrames /
Columns; nothing collects rows to the driver except fitted scalars (medians,
counts, model parameters).
"""

from cirflow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
