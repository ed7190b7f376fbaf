"""delaylake: event-delay reporting over a bronze/silver/gold lakehouse on Spark.

Everything is DataFrame in, DataFrame out.  ``functions`` holds column
expressions, ``operators`` the relational steps, ``sources`` the readers,
``plans`` the composed pipelines and jobs, ``streaming`` the micro-batch flows.
"""

from delaylake.config import LakeConfig
from delaylake.session import build_session, configure

__all__ = ["LakeConfig", "build_session", "configure"]
