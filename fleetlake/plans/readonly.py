"""What a statement may do, told from its parsed plan: read the lake's tables and views, with known functions."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import SparkSession

# Spark's names for the steps of a query that only reads, and for commands that only tell what there is.
READS = frozenset(
    """Aggregate Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit Offset
    OneRowRelation Pivot PipeOperator Project Sort SubqueryAlias Tail Union Unpivot UnresolvedHaving UnresolvedHint
    UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedTableValuedFunction
    UnresolvedWith WithWindowDefinition""".split()
)
TELLS = frozenset(
    """CurrentNamespace DescribeColumn DescribeFunction DescribeRelation ExplainCommand ShowColumns ShowCreateTable
    ShowFunctions ShowNamespacesCommand ShowPartitions ShowTableProperties ShowTables ShowViews UnresolvedFunctionName
    UnresolvedNamespace UnresolvedTable UnresolvedTableOrView""".split()
)

# Functions that depend on their arguments only and reach nothing outside the query.
KNOWN = frozenset(
    """abs acos any any_value approx_count_distinct approx_percentile array array_agg array_contains array_distinct
    array_join array_max array_min array_position array_size array_sort ascii asin atan avg bigint bit_and bit_or
    bool_and bool_or boolean btrim cardinality cast ceil ceiling char_length coalesce collect_list collect_set concat
    concat_ws contains corr cos count count_if covar_pop cume_dist current_date current_timestamp date date_add
    date_diff date_format date_sub date_trunc datediff day dayofmonth dayofweek dayofyear decimal decode dense_rank
    double element_at endswith every exists exp explode explode_outer extract filter first first_value flatten float
    floor format_string from_json get_json_object greatest hash hour if ifnull initcap inline instr int isnan isnotnull
    isnull json_tuple kurtosis lag last last_day last_value lcase lead least left length like ln locate log log10 log2
    lower lpad ltrim make_date map map_keys map_values max max_by mean median min min_by minute mod mode month
    months_between named_struct now nth_value ntile nullif nvl nvl2 parse_json percent_rank percentile pmod posexplode
    position pow power quarter rank regexp_count regexp_extract regexp_like regexp_replace regr_slope repeat replace
    reverse right rint rlike round row_number rpad rtrim second sequence sha2 sign size skewness slice some sort_array
    split sqrt startswith std stddev string struct substr substring sum tan timestamp timestampadd timestampdiff
    to_date to_json to_timestamp transform translate trim trunc try_cast try_divide ucase unix_timestamp upper
    variance variant_get weekday weekofyear width_bucket xxhash64 year""".split()
)

_PLAN = "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"
_WITH_PLAN = "org.apache.spark.sql.catalyst.expressions.PlanExpression"


def _each(values: JavaObject) -> Iterator[JavaObject]:
    for i in range(values.size()):
        yield values.apply(i)


class _Check:
    def __init__(self, spark: SparkSession, tables: set[str], namespaces: set[str], functions: set[str]):
        self.gateway = spark.sparkContext._gateway
        self.tables, self.namespaces, self.functions = tables, namespaces, KNOWN | functions

    def plan(self, node: JavaObject, named: frozenset[str]) -> None:
        """Refuse what is not known; ``named`` are the tables that the statement itself defines around ``node``."""
        kind = node.getClass().getSimpleName().rstrip("$")
        if kind not in READS and kind not in TELLS:
            raise ValueError(f"blocked operation: {kind}")
        if kind in ("UnresolvedRelation", "UnresolvedTable", "UnresolvedTableOrView"):
            self.table(node.multipartIdentifier(), named)
        elif kind == "UnresolvedNamespace":
            if self.name(node.multipartIdentifier()) not in self.namespaces | {""}:
                raise ValueError(f"blocked namespace: {self.name(node.multipartIdentifier())}")
        elif kind == "UnresolvedTableValuedFunction":
            self.function(self.name(node.name()))
        elif kind == "ExplainCommand":
            self.plan(node.logicalPlan(), named)
        elif kind == "UnresolvedWith":
            for definition in self.inner(node):
                own = definition.alias().lower()
                self.plan(definition, named | {own} if node.allowRecursion() else named)
                named = named | {own}
        elif kind == "WithWindowDefinition":
            for definition in _each(node.windowDefinitions().values().toSeq()):
                self.expression(definition, named)
        for child in _each(node.children()):
            self.plan(child, named)
        for expression in _each(node.expressions()):
            self.expression(expression, named)

    def inner(self, node: JavaObject) -> list[JavaObject]:
        return [n for n in _each(node.innerChildren()) if is_instance_of(self.gateway, n, _PLAN)]

    def expression(self, node: JavaObject, named: frozenset[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            self.function(self.name(node.nameParts()))
            if node.filter().isDefined():
                self.expression(node.filter().get(), named)
        elif kind == "UnresolvedGenerator":
            self.function(node.name().funcName())
        if is_instance_of(self.gateway, node, _WITH_PLAN):
            self.plan(node.plan(), named)
        for child in _each(node.children()):
            self.expression(child, named)

    @staticmethod
    def name(parts: JavaObject) -> str:
        return ".".join(_each(parts)).lower()

    def table(self, parts: JavaObject, named: frozenset[str]) -> None:
        name = self.name(parts).removeprefix("spark_catalog.")
        if name not in self.tables and name not in named:
            raise ValueError(f"blocked table: {name}")

    def function(self, name: str) -> None:
        if name.lower() not in self.functions:
            raise ValueError(f"blocked function: {name}")


def require_known(
    spark: SparkSession, statement: str, tables: set[str], namespaces: set[str], functions: set[str]
) -> None:
    """ValueError unless the statement only reads these tables and views, with known functions or these.

    The statement is parsed, not analysed, so nothing in it is evaluated and no file is looked at. A path instead of
    a table, a function that calls Java or reads files, and every plan step not listed above are refused.
    """
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    _Check(spark, {t.lower() for t in tables}, {n.lower() for n in namespaces}, functions).plan(plan, frozenset())
