"""usagelake: device and app usage metrics on Spark.

Phone reports (device attributes plus a nested list of app sessions) become
incrementally maintained metric tables.  Everything is expressed with the
DataFrame API so Catalyst plans the work; see README.md for the layout.
"""

from usagelake.session import build_session, shared_dir
from usagelake.operators.model import Usage

__all__ = ["build_session", "shared_dir", "Usage"]
