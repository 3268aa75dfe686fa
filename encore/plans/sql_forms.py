"""The SQL statements of the flows as text over registered views.

Names of views and columns are arguments (``IDENTIFIER(:name)``), values are named parameters; no
statement is put together from strings, so a name or value can never change what it does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Statement form -> text.  ``:view`` is a view; ``:a`` and ``:b`` are its columns; ``:n`` is a number.
FORMS = {
    "count": "SELECT count(*) AS n_rows FROM IDENTIFIER(:view)",
    "count_distinct": "SELECT count(*) AS n_rows, count(DISTINCT IDENTIFIER(:a)) AS n_a, count(DISTINCT IDENTIFIER(:b)) AS n_b FROM IDENTIFIER(:view)",
    "some_key": "SELECT * FROM IDENTIFIER(:view) WHERE IDENTIFIER(:a) IS NOT NULL OR IDENTIFIER(:b) IS NOT NULL",
    "distinct": "SELECT DISTINCT * FROM IDENTIFIER(:view)",
    "first_rows": "SELECT * FROM IDENTIFIER(:view) ORDER BY ALL LIMIT :n",
}


def register(df: DataFrame, view: str) -> str:
    """Make ``df`` readable as ``view`` in this session; the name is returned."""
    df.createOrReplaceTempView(view)
    return view


def run_form(spark: SparkSession, form: str, **args) -> DataFrame:
    """The result of a statement of ``FORMS``."""
    if form not in FORMS:
        raise ValueError(f"unknown statement {form!r}; there are {', '.join(FORMS)}")
    return spark.sql(FORMS[form], args=args)
