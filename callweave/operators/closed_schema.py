"""Closed schemas as column rules: a tree of node types says what a JSON value may hold, and every place that breaks it becomes a row with its path.

The value is a VARIANT, so keys the schema does not know, values of another type and missing fields are all seen. The walk happens when
the plan is built; what runs are column functions, lists included, whatever their length.
"""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

PROBLEM = "struct<path: string, problem: string>"


def _none():
    return F.array().cast(f"array<{PROBLEM}>")


def _found(condition, path, problem):
    """An array with one problem, or none; a null condition is none."""
    return F.when(condition, F.array(F.struct(path.alias("path"), (F.lit(problem) if isinstance(problem, str) else problem).alias("problem")))).otherwise(_none())


def _get(value, kind):
    return F.try_variant_get(value, "$", kind)


def _kind(value):
    """STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN or VOID; for objects and lists their fields follow."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _let(value, use):
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


@dataclass(frozen=True)
class Text:
    """A string of least to most characters; `filled` asks for more than white space; `choice` allows listed values only."""
    most: int = 2**31 - 1
    least: int = 0
    filled: bool = False
    choice: tuple = ()

    def check(self, value, path):
        def rules(text):
            found = []
            if self.least:
                found.append((F.length(text) < self.least, "text too short"))
            if self.most < 2**31 - 1:
                found.append((F.length(text) > self.most, "text too long"))
            if self.filled:
                found.append(((F.length(text) >= self.least) & ~text.rlike(r"(?U)\S"), "blank text"))
            if self.choice:
                found.append((~text.isin(*self.choice), "value not allowed"))
            return F.concat(*[_found(rule, path, problem) for rule, problem in found]) if found else _none()

        return F.when(_kind(value) != "STRING", _found(F.lit(True), path, "not a text")).otherwise(_let(_get(value, "string"), rules))


@dataclass(frozen=True)
class Whole:
    least: int = -2**63

    def check(self, value, path):
        return F.when(_kind(value) != "BIGINT", _found(F.lit(True), path, "not a whole number")).otherwise(_found(_get(value, "bigint") < self.least, path, "number too small"))


@dataclass(frozen=True)
class Number:
    def check(self, value, path):
        return _found(~_kind(value).isin("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), path, "not a number")


@dataclass(frozen=True)
class Flag:
    def check(self, value, path):
        return _found(_kind(value) != "BOOLEAN", path, "not true or false")


@dataclass(frozen=True)
class Nullable:
    """The node, or null."""
    node: object

    def check(self, value, path):
        return F.when(F.is_variant_null(value), _none()).otherwise(self.node.check(value, path))


@dataclass(frozen=True)
class Items:
    """A list of at most `most` of the node; paths end in [index] from 0."""
    node: object
    most: int = 2**31 - 1

    def check(self, value, path):
        def within(items):
            each = F.transform(items, lambda x, i: self.node.check(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            return F.when(items.isNull(), _found(F.lit(True), path, "not a list")).otherwise(
                F.concat(_found(F.size(items) > self.most, path, "too many items"), F.flatten(each)))

        return _let(_get(value, "array<variant>"), within)


@dataclass(frozen=True)
class Record:
    """An object with these fields and no others; those named optional may be missing."""
    fields: dict = field(default_factory=dict)
    optional: tuple = ()

    def check(self, value, path):
        place = lambda name: F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))
        names = F.array(*[F.lit(n) for n in self.fields])

        def within(held):
            unknown = F.array_sort(F.array_except(F.map_keys(held), names))
            found = [F.transform(unknown, lambda k: F.struct(place(k).alias("path"), F.lit("unknown key").alias("problem")))]
            found += [_let(F.try_element_at(held, F.lit(name)), member(name, node)) for name, node in self.fields.items()]
            return F.when(held.isNull(), _found(F.lit(True), path, "not an object")).otherwise(F.concat(*found))

        def member(name, node):
            at = place(F.lit(name))
            missing = _none() if name in self.optional else _found(F.lit(True), at, "missing")
            # A null in JSON is a VARIANT null here, a missing field is none at all.
            return lambda inner: F.when(inner.isNull(), missing).otherwise(node.check(inner, at))

        return _let(_get(value, "map<string, variant>"), within)


def violations(df, body, schema, keep):
    """Rows of `keep` with path and problem for every place of the JSON text `body` that breaks the schema; text that is no JSON, null included, is
    one problem at the empty path."""
    value = F.try_parse_json(F.col(body))
    rows = df.withColumn("__value", value)
    empty = F.lit("")
    problems = F.when(F.col("__value").isNull(), _found(F.lit(True), empty, "not JSON")).otherwise(schema.check(F.col("__value"), empty))
    return rows.select(*keep, F.inline(problems))
