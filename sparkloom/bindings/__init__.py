"""Jobs bound to the test tables, each with the SQL it is checked against.

`QUERIES` maps a key to a function of (spark, table folder); `ORACLES` maps it to its SQL twin.
"""

from sparkloom.bindings import event_queries, nested_queries, reliability_queries, star_queries, stream_queries
from sparkloom.bindings import operation_queries, storage_queries, table_queries, text_queries

_MODULES = (text_queries, table_queries, star_queries, reliability_queries, nested_queries, event_queries,
            stream_queries, storage_queries, operation_queries)

QUERIES = {key: query for module in _MODULES for key, query in module.QUERIES.items()}
ORACLES = {key: text for module in _MODULES for key, text in module.ORACLES.items()}
