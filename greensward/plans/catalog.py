"""All queries of the vegetation-change engine by name, and their DuckDB SQL."""

from greensward.plans import flow, pixel, records, shapes, space, temporal

QUERIES: dict = pixel.QUERIES | space.QUERIES | temporal.QUERIES | records.QUERIES | flow.QUERIES | shapes.QUERIES
SQL: dict[str, str] = pixel.SQL | space.SQL | temporal.SQL | records.SQL | flow.SQL | shapes.SQL
