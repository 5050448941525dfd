"""How the grid functions are made.

Every function is a small builder of Spark SQL expression text. From that one text
come three ways to call it:

* ``gid_to_name("gid")`` - a Column; arguments are column names or SQL expressions,
  and the whole expression is parsed in one call and inlined in the plan;
* ``gid_to_name(F.col("gid"))`` - with Column arguments, through the SQL function;
* ``SELECT gid_to_name(gid)`` - after ``register_sql_functions(spark)``.

Text composes cheaply: an expression of hundreds of nodes costs one call from
Python, where building it operator by operator would cost hundreds.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, "GridFunction"] = {}


def literal(value) -> str:
    """SQL text of an argument: text is an expression already, numbers become literals."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if value is None:
        return "NULL"
    return value if isinstance(value, str) else str(value)


def col(value) -> Column:
    """A Column for a Column or an SQL expression."""
    return value if isinstance(value, Column) else F.expr(literal(value))


class GridFunction:
    """A builder of expression text with its SQL signature."""

    def __init__(self, build: Callable[..., str], params: str, returns: str):
        self.build, self.params, self.returns = build, params, returns
        self.name = build.__name__
        functools.update_wrapper(self, build)

    @property
    def param_names(self) -> list[str]:
        flat = self.params
        while "<" in flat:  # drop the members of struct and array types
            flat = re.sub(r"<[^<>]*>", "", flat)
        return [p.split()[0] for p in flat.split(",")] if flat else []

    def sql(self, *args, **options) -> str:
        """Expression text; integers are passed on as they are, so that builders can fold them."""
        return self.build(*[a if isinstance(a, int) and not isinstance(a, bool) else literal(a) for a in args], **options)

    def __call__(self, *args, **options) -> Column:
        if not any(isinstance(a, Column) for a in args):
            return F.expr(self.sql(*args, **options))
        spark = SparkSession.active()
        name = self.register(spark, **options)
        columns = [a if isinstance(a, Column) else F.expr(literal(a)) for a in args]
        return F.call_function(name, *columns)

    def register(self, spark: SparkSession, name: str | None = None, **options) -> str:
        """Create the temporary SQL function in the session; with options its name tells its body."""
        body = self.build(*self.param_names, **options)
        if name is None:
            name = f"{self.name}_{hashlib.sha256(body.encode()).hexdigest()[:24]}" if options else self.name
        if not spark.catalog.functionExists(name):
            spark.sql(f"CREATE TEMPORARY FUNCTION {name}({self.params}) RETURNS {self.returns} RETURN {body}")
        return name


def grid_function(params: str, returns: str) -> Callable[[Callable[..., str]], GridFunction]:
    """Make a builder of expression text a grid function with the given SQL signature."""

    def wrap(build: Callable[..., str]) -> GridFunction:
        fn = GridFunction(build, params, returns)
        REGISTRY[fn.name] = fn
        return fn

    return wrap


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register all grid functions as temporary SQL functions; Catalyst inlines them where used."""
    return [fn.register(spark) for fn in REGISTRY.values()]


def bind(value: str, var: str, body: str) -> str:
    """``body`` with the lambda variable ``var`` bound to a value that is evaluated once."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def quoted(text: str) -> str:
    """SQL string literal of any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def round_long(value: str) -> str:
    """Half-to-even rounding of a double to a 64-bit integer."""
    return f"bigint(rint({value}))"
