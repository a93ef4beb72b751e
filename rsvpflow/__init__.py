"""rsvpflow — invitation / contact analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names / small config)
and returns a lazy DataFrame; nothing is collected to the driver.
"""

from rsvpflow.roles import ROLES, RoleSpec  # noqa: F401
from rsvpflow.session import get_spark, work_dir  # noqa: F401
