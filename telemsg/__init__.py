"""telemsg: decode hex diagnostic messages from vehicles into typed Spark tables.

Every public function takes and returns DataFrames (or Columns) and builds a lazy
plan from native Spark expressions; no Python code runs on the data path.

Layout of the package:

* ``sources``    readers for telemetry, vehicle master, layouts, conversion tables, catalogue
* ``functions``  Column-expression builders (hex/bit extraction, rounding, text forms)
* ``operators``  DataFrame -> DataFrame operators (codec, decode, validate, fill, flatten, ...)
* ``plans``      end-to-end batch jobs and sinks
* ``streaming``  the same stateless decode plan on a streaming DataFrame
"""

from telemsg.catalogue import Catalogue, load_catalogue

__all__ = ["Catalogue", "load_catalogue"]
__version__ = "0.1.0"
