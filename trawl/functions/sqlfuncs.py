"""the display functions as SQL functions, for ``spark.sql`` users.

Each is a SQL user-defined function whose body is a built-in expression, so
Catalyst inlines it into the calling query (no Python, no serialisation).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Bodies mirror trawl.functions.urls (format_url, display_title, clean_path, format_score).
FUNCTIONS = {
    "format_url": (
        "url STRING",
        "STRING",
        r"regexp_replace(url, '^https://', '')",
    ),
    "display_title": (
        "url STRING",
        "STRING",
        r"""coalesce(
              get(filter(transform(reverse(split(url, '/')),
                    p -> array_join(
                           transform(filter(split(translate(regexp_replace(p, '\\.html\\z', ''), '-_', '  '), '(?U)\\s+'),
                                            w -> w != ''),
                                     w -> concat(upper(substring(w, 1, 1)), lower(substring(w, 2)))),
                           ' ')),
                  t -> t != ''), 0),
              regexp_replace(url, '^https://', ''))""",
    ),
    "clean_path": (
        "url STRING",
        "STRING",
        r"""concat(translate(lower(display_title(url)), ' /.', '---'), '-',
                  CAST(CAST(conv(substring(md5(url), 1, 8), 16, 10) AS BIGINT) % 1000 AS STRING))""",
    ),
    "format_score": ("x DOUBLE", "STRING", r"format_string('%.4f', x)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(FUNCTIONS)
