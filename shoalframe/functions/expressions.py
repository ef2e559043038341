"""Filter expressions: a safe subset of Python compiled to columns. Nothing is evaluated."""

from __future__ import annotations

import ast
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.Mod: operator.mod, ast.Pow: lambda a, b: F.pow(a, b), ast.FloorDiv: lambda a, b: F.floor(a / b)}
_COMPARE = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge}
_CALLS = {"abs": F.abs, "len": F.length, "round": F.round, "str": lambda c: c.cast("string"), "int": lambda c: c.cast("long"), "float": lambda c: c.cast("double"), "min": F.least, "max": F.greatest}
_METHODS = {
    "startswith": lambda c, x: c.startswith(x),
    "endswith": lambda c, x: c.endswith(x),
    "lower": F.lower,
    "upper": F.upper,
    "strip": F.trim,
}


class ExpressionError(ValueError):
    """An expression outside the supported subset."""


def names(text: str) -> set[str]:
    """The columns that an expression reads."""
    called = {n.func.id for n in ast.walk(ast.parse(text, mode="eval")) if isinstance(n, ast.Call) and isinstance(n.func, ast.Name)}
    return {n.id for n in ast.walk(ast.parse(text, mode="eval")) if isinstance(n, ast.Name)} - called


def compile_expression(text: str) -> Column:
    """The column of a Python expression over column names.

    Arithmetic, comparisons (chained ones too), and/or/not, in, is None, conditional expressions, the calls
    abs len round str int float min max and the string methods startswith endswith lower upper strip are
    supported. An unknown column fails when the plan is analysed.
    """
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except SyntaxError as e:
        raise ExpressionError(f"{text!r}: {e}") from e

    def literal(node: ast.AST) -> object:
        try:
            return ast.literal_eval(node)
        except ValueError as e:
            raise ExpressionError(f"{text!r}: a constant is needed") from e

    def build(node: ast.AST) -> Column:
        match node:
            case ast.Constant():
                return F.lit(node.value)
            case ast.Name():
                return F.col(f"`{node.id}`")
            case ast.Subscript(value=ast.Name(id="meta"), slice=ast.Constant(value=str(key))):
                return F.col(f"`{key}`")
            case ast.BinOp() if type(node.op) in _BINARY:
                return _BINARY[type(node.op)](build(node.left), build(node.right))
            case ast.UnaryOp(op=ast.Not()):
                return ~truth(node.operand)
            case ast.UnaryOp(op=ast.USub()):
                return -build(node.operand)
            case ast.BoolOp():
                parts = [truth(v) for v in node.values]
                join = operator.and_ if isinstance(node.op, ast.And) else operator.or_
                out = parts[0]
                for p in parts[1:]:
                    out = join(out, p)
                return out
            case ast.Compare():
                out, left = None, node.left
                for op, right in zip(node.ops, node.comparators, strict=True):
                    one = compare(left, op, right)
                    out, left = one if out is None else out & one, right
                return out
            case ast.IfExp():
                return F.when(truth(node.test), build(node.body)).otherwise(build(node.orelse))
            case ast.Call(func=ast.Name(id=name)) if name in _CALLS and not node.keywords:
                args = [build(a) for a in node.args]
                if name == "round" and len(node.args) == 2:
                    return F.round(args[0], int(literal(node.args[1])))
                return _CALLS[name](*args)
            case ast.Call(func=ast.Attribute(value=value, attr=name)) if name in _METHODS and not node.keywords:
                return _METHODS[name](build(value), *[build(a) for a in node.args])
        raise ExpressionError(f"{text!r}: {type(node).__name__} isn't supported")

    def compare(left: ast.AST, op: ast.cmpop, right: ast.AST) -> Column:
        if isinstance(op, (ast.Is, ast.IsNot)):
            if literal(right) is not None:
                raise ExpressionError(f"{text!r}: `is` takes None only")
            return build(left).isNull() if isinstance(op, ast.Is) else build(left).isNotNull()
        if isinstance(op, (ast.In, ast.NotIn)):
            if isinstance(right, (ast.Tuple, ast.List, ast.Set)):
                out = build(left).isin(list(literal(right)))
            else:
                out = F.contains(build(right), build(left))
            return out if isinstance(op, ast.In) else ~out
        return _COMPARE[type(op)](build(left), build(right))

    def truth(node: ast.AST) -> Column:
        """Comparisons as they are; a bare value is true as in Python."""
        if isinstance(node, (ast.Compare, ast.BoolOp)) or isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
            return build(node)
        if isinstance(node, ast.Constant):
            return F.lit(bool(node.value))
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in ("startswith", "endswith"):
            return build(node)
        value = build(node)
        return F.coalesce(~value.cast("string").isin("", "0", "0.0", "false", "False"), F.lit(False))

    return truth(tree.body)


def ignore_pattern(pattern: str) -> str:
    """A shell pattern as a regular expression over a whole path."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[" and (j := pattern.find("]", i + 2)) > 0:
            inner = pattern[i + 1 : j].replace("\\", "\\\\")
            out += f"[^{inner[1:]}]" if inner[0] == "!" else f"[{inner}]"
            i = j
        else:
            out += {"*": ".*", "?": "."}.get(c) or re.escape(c)
        i += 1
    return f"(?s)^{out}$"
