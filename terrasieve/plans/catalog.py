"""All queries of the library and their SQL."""

from terrasieve.plans import oracle, overlay_oracle, overlay_queries, queries, raster_oracle, raster_queries

QUERIES = {**queries.QUERIES, **overlay_queries.QUERIES, **raster_queries.QUERIES}
SQL = {**oracle.SQL, **overlay_oracle.SQL, **raster_oracle.SQL}
