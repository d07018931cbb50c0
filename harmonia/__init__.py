"""harmonia: survey-data harmonisation as lazy Spark DataFrame transformations.

Every cleaning operator returns a :class:`harmonia.frame.Result` holding the
transformed DataFrame and a dict of audit DataFrames (both lazy).  Column
names are parameters everywhere; nothing is wired to one data set.
"""

from harmonia.frame import Result, with_row_id, ROW_ID
from harmonia.session import get_session, checkpoint_dir

__all__ = ["Result", "with_row_id", "ROW_ID", "get_session", "checkpoint_dir"]
