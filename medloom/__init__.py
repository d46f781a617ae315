"""Clinical analytics as Spark DataFrame operators.

Packages:

* ``functions``  - Column builders (document paths, clinical derivations, hashing)
* ``sources``    - readers and writers
* ``operators``  - DataFrame -> DataFrame operators
* ``streaming``  - the same operators under Structured Streaming
* ``plans``      - whole flows (landing -> raw -> staging -> mart) and the query catalogue
"""

from medloom.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
