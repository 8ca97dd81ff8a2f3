"""railyard: scheduled-movement analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; nothing is collected to the driver except small control values in
the iterative graph loops (a row count per round).
"""

from railyard.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
