"""Expressions, as Spark SQL text.

Every function takes column names or SQL expressions and returns a SQL
expression for ``selectExpr``, ``F.expr`` or ``spark.sql``. Text composes without
a driver round trip per operator, and it is parsed into the same built-in,
code-generated Catalyst expressions.
"""
