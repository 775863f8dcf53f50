"""Training-data operators: corpus operators, their queries and helpers.

Nothing else in the library imports this package.  Operators that run Python in
tasks need the package on the executors (installed, or shipped with
``--py-files``); ``prepare`` sees to that where tasks run on the driver's host.
"""

import os

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark) -> None:
    """Make the package importable for Python workers started on this host."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (_ROOT, env.get("PYTHONPATH"))))
