"""``calculate_field`` formulas: a small, allow-listed expression language.

The text is parsed with Python's ``ast`` module and translated node by node
into a Spark Column, so the computation runs JVM-side. Anything outside the
allow-list is rejected at plan time. Semantics follow pandas ``eval``: nulls
propagate through arithmetic, comparisons with null are False, ``/`` is IEEE
division (x/0 = +-inf, 0/0 = missing), ``//`` floors and ``%`` follows the
sign of the divisor.
"""

from __future__ import annotations

import ast

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import types as TY
from .predicates import Resolver, SpecError

_INF = float("inf")

_MATH = {
    "sin": F.sin, "cos": F.cos, "tan": F.tan, "arcsin": F.asin, "arccos": F.acos, "arctan": F.atan,
    "sinh": F.sinh, "cosh": F.cosh, "tanh": F.tanh, "arcsinh": F.asinh, "arccosh": F.acosh,
    "arctanh": F.atanh, "exp": F.exp, "expm1": F.expm1, "log": F.log, "log1p": F.log1p,
    "log10": F.log10, "sqrt": F.sqrt, "abs": F.abs, "floor": F.floor, "ceil": F.ceil,
}
_NULL_METHODS = {"isna", "isnull", "notna", "notnull"}


def _ieee_div(a: Column, b: Column) -> Column:
    a, b = a.cast("double"), b.cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, a / b)
        .when(a > 0, F.lit(_INF))
        .when(a < 0, F.lit(-_INF))
        .otherwise(F.lit(None).cast("double"))
    )


class _Compiler:
    def __init__(self, resolve: Resolver):
        self.resolve = resolve

    def __call__(self, node) -> tuple[Column, str]:
        m = getattr(self, "_" + type(node).__name__, None)
        if m is None:
            raise SpecError(f"formula element not allowed: {type(node).__name__}")
        return m(node)

    def _Expression(self, n):
        return self(n.body)

    def _Name(self, n):
        r = self.resolve(n.id)
        if r is None:
            if n.id in ("True", "False"):
                return F.lit(n.id == "True"), TY.BOOL
            raise SpecError(f"formula refers to unknown column {n.id!r}")
        c, fam = r
        if fam == TY.FLOAT:
            c = TY.nan_to_null(c)
        return c, fam

    def _Constant(self, n):
        v = n.value
        fam = TY.value_family(v)
        if fam == TY.OTHER:
            raise SpecError(f"formula constant not allowed: {v!r}")
        return TY.lit_of(v), fam

    def _UnaryOp(self, n):
        c, fam = self(n.operand)
        if isinstance(n.op, ast.USub):
            return -c, fam
        if isinstance(n.op, ast.UAdd):
            return c, fam
        if isinstance(n.op, (ast.Not, ast.Invert)):
            if fam == TY.INT and isinstance(n.op, ast.Invert):
                return F.bitwise_not(c), TY.INT
            return ~F.coalesce(c.cast("boolean"), F.lit(False)), TY.BOOL
        raise SpecError("unary operator not allowed")

    def _BinOp(self, n):
        (a, fa), (b, fb) = self(n.left), self(n.right)
        op = n.op
        both_int = fa in (TY.INT, TY.BOOL) and fb in (TY.INT, TY.BOOL)
        if isinstance(op, (ast.BitAnd, ast.BitOr)):
            if both_int and fa == TY.INT:
                return (a.bitwiseAND(b) if isinstance(op, ast.BitAnd) else a.bitwiseOR(b)), TY.INT
            a = F.coalesce(a.cast("boolean"), F.lit(False))
            b = F.coalesce(b.cast("boolean"), F.lit(False))
            return (a & b if isinstance(op, ast.BitAnd) else a | b), TY.BOOL
        if isinstance(op, ast.Add) and fa == TY.STRING and fb == TY.STRING:
            return F.concat(a, b), TY.STRING
        if fa not in TY.NUMERIC + (TY.BOOL,) or fb not in TY.NUMERIC + (TY.BOOL,):
            raise SpecError(f"arithmetic on non-numeric operands ({fa}, {fb})")
        if isinstance(op, ast.Add):
            return (F.try_add(a, b), TY.INT) if both_int else (a + b, TY.FLOAT)  # past bigint: null
        if isinstance(op, ast.Sub):
            return (F.try_subtract(a, b), TY.INT) if both_int else (a - b, TY.FLOAT)
        if isinstance(op, ast.Mult):
            return (F.try_multiply(a, b), TY.INT) if both_int else (a * b, TY.FLOAT)
        if isinstance(op, ast.Div):
            return _ieee_div(a, b), TY.FLOAT
        if isinstance(op, ast.FloorDiv):
            q = F.floor(_ieee_div(a, b))
            if both_int:
                return F.when(b != 0, q.cast("long")), TY.INT
            return F.when(b != 0, q.cast("double")).otherwise(_ieee_div(a, b)), TY.FLOAT
        if isinstance(op, ast.Mod):
            da, db = a.cast("double"), b.cast("double")
            r = da - db * F.floor(da / F.when(db != 0, db))
            if both_int:
                return F.when(b != 0, r.cast("long")), TY.INT
            return r, TY.FLOAT
        if isinstance(op, ast.Pow):
            p = F.pow(a.cast("double"), b.cast("double"))
            if both_int:
                return p.try_cast("long"), TY.INT
            return p, TY.FLOAT
        raise SpecError("binary operator not allowed")

    def _BoolOp(self, n):
        vals = [F.coalesce(self(v)[0].cast("boolean"), F.lit(False)) for v in n.values]
        out = vals[0]
        for v in vals[1:]:
            out = (out & v) if isinstance(n.op, ast.And) else (out | v)
        return out, TY.BOOL

    def _Compare(self, n):
        left = self(n.left)
        out = None
        for op, right_node in zip(n.ops, n.comparators):
            right = self(right_node)
            part = self._cmp(op, left, right)
            out = part if out is None else (out & part)
            left = right
        return out, TY.BOOL

    def _cmp(self, op, left, right) -> Column:
        (a, fa), (b, fb) = left, right
        same = TY.comparable(fa, fb) or fa == TY.NULL or fb == TY.NULL
        if isinstance(op, (ast.Eq, ast.NotEq)):
            if not same:
                return F.lit(isinstance(op, ast.NotEq))
            eq = F.coalesce(a == b, F.lit(False))
            return eq if isinstance(op, ast.Eq) else ~eq
        if not same:
            raise SpecError(f"cannot compare {fa} with {fb}")
        fn = {ast.Lt: a.__lt__, ast.LtE: a.__le__, ast.Gt: a.__gt__, ast.GtE: a.__ge__}.get(type(op))
        if fn is None:
            raise SpecError("comparison not allowed")
        return F.coalesce(fn(b), F.lit(False))

    def _IfExp(self, n):
        cond = F.coalesce(self(n.test)[0].cast("boolean"), F.lit(False))
        (a, fa), (b, fb) = self(n.body), self(n.orelse)
        fam = TY.common_family(fa, fb)
        return F.when(cond, TY.to_family(a, fa, fam)).otherwise(TY.to_family(b, fb, fam)), fam

    def _Call(self, n):
        if isinstance(n.func, ast.Name) and n.func.id in _MATH and len(n.args) == 1 and not n.keywords:
            c, fam = self(n.args[0])
            fn = _MATH[n.func.id]
            if n.func.id in ("abs",):
                return fn(c), fam
            if n.func.id in ("log", "log10", "sqrt", "log1p"):
                d = c.cast("double")
                # domain errors give NaN in pandas: missing
                return F.when(d >= (-1 if n.func.id == "log1p" else 0), fn(d)), TY.FLOAT
            return fn(c.cast("double")), TY.FLOAT
        if isinstance(n.func, ast.Attribute):
            target, fam = self(n.func.value)
            meth = n.func.attr
            if meth == "fillna" and len(n.args) == 1:
                fill, ff = self(n.args[0])
                out = TY.common_family(fam, ff)
                return F.coalesce(TY.to_family(target, fam, out), TY.to_family(fill, ff, out)), out
            if meth in _NULL_METHODS and not n.args:
                missing = target.isNull()
                return (missing if meth in ("isna", "isnull") else ~missing), TY.BOOL
            if meth == "abs" and not n.args:
                return F.abs(target), fam
            if meth == "round":
                nd = n.args[0].value if n.args and isinstance(n.args[0], ast.Constant) else 0
                return F.bround(target, int(nd)), fam
        raise SpecError("function call not allowed in formula")


def compile_formula(text: str, resolve: Resolver) -> tuple[Column, str]:
    """Formula text -> (Column, family). Raises SpecError on anything not allowed."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except SyntaxError as e:
        raise SpecError(f"invalid formula {text!r}: {e}") from e
    c, fam = _Compiler(resolve)(tree)
    if fam == TY.FLOAT:
        c = TY.nan_to_null(c.cast("double"))
    return c, fam
