"""A SPARQL subset compiled to DataFrame plans over triples (s, p, o).

SELECT [DISTINCT] with variables, (COUNT(*) AS ?n), (COUNT([DISTINCT] ?x) AS ?n), (MIN(?x) AS ?y), (MAX(...) AS ?y); ASK.
In a group: triples with ``;`` and ``,``, paths ``a/b``, ``p*``, ``p+``, ``p?``, OPTIONAL, UNION, FILTER with
comparisons, ``&&``, ``||``, ``!``, DAY/MONTH/YEAR/LANG-free terms and [NOT] EXISTS, BIND. Then GROUP BY, ORDER BY, LIMIT.
DELETE { template } WHERE { group }, with WITH <graph>: see :func:`update`; FROM <graph> limits a query to named graphs.
Prefixed names stand for their local part's term: ``:during`` and ``during`` are the predicate "during".
Sequences have bag semantics, ``* + ?`` set semantics. A graph pattern's joins are left to Catalyst.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.operators import patterns

TOKEN = re.compile(r'\s*(?:#[^\n]*\n\s*)*("(?:[^"\\]|\\.)*"|<[^<>\s]*>|\?\w+|!=|<=|>=|&&|\|\||[(){}.;,/*+?=<>!]|[\w:-]+)')
FUNCTIONS = {"YEAR": F.year, "MONTH": F.month, "DAY": F.dayofmonth}


def tokens(text: str) -> list[str]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected text: {text[at : at + 30]!r}")
        out.append(m[1])
        at = m.end()
    return out


class Query:
    """One query over one triples DataFrame; with ``graph``, the name of a column, over each of its graphs apart."""

    def __init__(self, triples: DataFrame, text: str, graph: str | None = None):
        self.by = (graph,) if graph else ()
        self.all, self.t = triples, triples.select(*self.by, "s", "p", "o")
        self.ts, self.at, self.fresh = tokens(text), 0, 0
        self.named: list[str] = []
        self.loose: set[str] = set()  # variables that a solution may leave unbound

    # tokens
    def peek(self, ahead: int = 0) -> str:
        return self.ts[self.at + ahead] if self.at + ahead < len(self.ts) else ""

    def word(self) -> str:
        return self.peek().upper()

    def next(self, want: str | None = None) -> str:
        got = self.peek()
        if want is not None and got.upper() != want:
            raise ValueError(f"expected {want}, found {got!r}")
        self.at += 1
        return got

    def take(self, want: str) -> bool:
        if self.word() == want:
            self.at += 1
            return True
        return False

    @staticmethod
    def term(token: str) -> str:
        if token[0] == '"':
            return re.sub(r"\\(.)", r"\1", token[1:-1])
        return token[1:-1] if token[0] == "<" else token.rsplit(":", 1)[-1]

    def hidden(self) -> str:
        self.fresh += 1
        return f"_h{self.fresh}"

    def both(self, a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
        """Join on common variables; one that a side may leave unbound agrees with anything there and takes the other side's value."""
        common = [c for c in a.columns if c in b.columns]
        loose = [c for c in common if c in self.loose]
        if not loose:
            return patterns.both(a, b, how)
        names = {c: self.hidden() for c in common}
        other = b.select(*[F.col(c).alias(names.get(c, c)) for c in b.columns])
        agree = F.lit(True)
        for c, h in names.items():
            same = F.col(c) == F.col(h)
            agree &= same | F.col(c).isNull() | F.col(h).isNull() if c in loose else same
        out = a.join(other, agree, how)
        return out.withColumns({c: F.coalesce(c, names[c]) for c in loose}).drop(*names.values())

    def prologue(self) -> None:
        while self.take("PREFIX"):
            self.next()
            self.next()

    def graphs(self, word: str, column: str = "month") -> None:
        """Named graphs limit the triples, so only their files are read."""
        names = []
        while self.take(word):
            self.take("NAMED")
            names.append(self.term(self.next()))
        self.named = names
        if names:
            self.all = self.all.where(F.col(column).isin(*names))
            self.t = self.all.select(*self.by, "s", "p", "o")

    # query forms
    def update(self, given: DataFrame | None) -> DataFrame:
        """The triples of ``self.all`` that a DELETE takes out."""
        self.prologue()
        self.graphs("WITH")
        self.next("DELETE")
        self.next("{")
        template = []
        while not self.take("}"):
            if not self.take("."):
                template += self.template()
        self.next("WHERE")
        found = self.group(given)
        term = lambda x: (F.col(x[1:]) if x.startswith("?") else F.lit(self.term(x))).cast("string")
        rows = F.array(*[F.struct(*[term(x).alias(c) for x, c in zip(t, ("s", "p", "o"), strict=True)]) for t in template])
        return found.select(*self.by, F.inline(rows)).dropna(subset=["s", "p", "o"]).distinct()

    def template(self) -> list[tuple[str, str, str]]:
        subject, out = self.next(), []
        while True:
            name = self.next()
            while True:
                out.append((subject, "type" if name == "a" else name, self.next()))
                if not self.take(","):
                    break
            if not self.take(";"):
                return out

    def run(self) -> DataFrame:
        self.prologue()
        if self.take("ASK"):
            self.graphs("FROM")
            self.take("WHERE")
            found = self.group()
            if not self.by:
                return found.limit(1).agg((F.count("*") > 0).alias("answer"))
            return patterns.exists_flag(self.t.select(*self.by).distinct(), found, "answer")
        self.next("SELECT")
        distinct, shown = self.take("DISTINCT"), []
        while self.word() not in ("FROM", "WHERE", "{"):
            if self.take("("):
                shown.append(self.aggregate())
                self.next(")")
            elif self.take("*"):
                shown = None
            else:
                shown.append((self.next()[1:], None))
        self.graphs("FROM")
        self.take("WHERE")
        df = self.group()
        keys = []
        if self.take("GROUP"):
            self.next("BY")
            while self.peek().startswith("?"):
                keys.append(self.next()[1:])
        if shown is None:
            names = [c for c in df.columns if not c.startswith("_h") and c not in self.by]
        else:
            names = [n for n, _ in shown]
            keys = [*self.by, *keys] if keys or self.by else keys
            if any(a is not None for _, a in shown):
                df = df.groupBy(*keys).agg(*[a.alias(n) for n, a in shown if a is not None])
            elif len(keys) > len(self.by):
                df = df.select(*keys).distinct()
        df = df.select(*self.by, *names)
        order = []
        df = df.distinct() if distinct else df
        if self.take("ORDER"):
            self.next("BY")
            while self.peek() and self.word() != "LIMIT":
                down = self.take("DESC")
                self.take("(")
                name = self.next()[1:]
                self.take(")")
                order.append(F.desc(name) if down else F.asc(name))
            df = df.orderBy(*self.by, *order)
        if not self.take("LIMIT"):
            return df
        n = int(self.next())
        if not self.by:
            return df.limit(n)
        place = F.row_number().over(Window.partitionBy(*self.by).orderBy(*(order or [F.lit(0)])))
        return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")

    def aggregate(self) -> tuple[str, Column]:
        kind = self.next().upper()
        self.next("(")
        distinct = self.take("DISTINCT")
        column = F.lit(1) if self.take("*") else F.col(self.next()[1:])
        self.next(")")
        self.next("AS")
        made = {"COUNT": F.count_distinct if distinct else F.count, "MIN": F.min, "MAX": F.max, "SUM": F.sum, "AVG": F.avg}[kind](column)
        return self.next()[1:], made

    # graph patterns
    def one_row(self) -> DataFrame:
        """The empty group's solution, which binds nothing."""
        if self.by:
            return self.t.select(*self.by).distinct()
        return self.t.sparkSession.range(1).select(F.lit(1).alias(self.hidden()))

    def group(self, df: DataFrame | None = None) -> DataFrame:
        """{ ... }: parts are joined in order, to solutions given if there are; filters hold for the whole group."""
        self.next("{")
        filters: list = []
        while not self.take("}"):
            if self.take("."):
                continue
            if self.take("OPTIONAL"):
                df, more = self.one_row() if df is None else df, self.group()
                df, new = self.both(df, more, "left"), set(more.columns) - set(df.columns)
                self.loose |= new
            elif self.take("FILTER"):
                negated = self.take("NOT")
                if self.take("EXISTS"):
                    filters.append(("left_anti" if negated else "left_semi", self.group()))
                else:
                    self.next("(")
                    filters.append((None, self.disjunction()))
                    self.next(")")
            elif self.take("BIND"):
                self.next("(")
                value = self.value()
                self.next("AS")
                df = (self.one_row() if df is None else df).withColumn(self.next()[1:], value)
                self.next(")")
            elif self.peek() == "{":
                part = self.group()
                while self.take("UNION"):
                    other = self.group()
                    self.loose |= set(part.columns) ^ set(other.columns)
                    part = patterns.union(part, other)
                df = part if df is None else self.both(df, part)
            else:
                for part in self.triples():
                    df = part if df is None else self.both(df, part)
        df = self.one_row() if df is None else df
        for how, x in filters:
            if how is None:
                df = df.where(x)
            else:
                df = df.join(x, [c for c in df.columns if c in x.columns], how)
        return df

    def triples(self) -> list[DataFrame]:
        subject, out = self.next(), []
        while True:
            path = self.path()
            while True:
                out.append(self.edge(subject, path, self.next()))
                if not self.take(","):
                    break
            if not self.take(";"):
                return out

    def path(self) -> list[tuple[str, str]]:
        steps = []
        while True:
            name = self.next()
            sign = self.next() if self.peek() in ("*", "+", "?") else ""
            steps.append(("type" if name == "a" else name, sign))
            if not self.take("/"):
                return steps

    def edge(self, subject: str, path: list[tuple[str, str]], obj: str) -> DataFrame:
        ends = [self.hidden() for _ in range(len(path) + 1)]
        df = None
        for i, (name, sign) in enumerate(path):
            s, o = ends[i], ends[i + 1]
            if name.startswith("?"):
                part = self.t.select(*self.by, F.col("s").alias(s), F.col("p").alias(name[1:]), F.col("o").alias(o))
            elif sign:
                nodes = self.t.select(*self.by, "s").union(self.t.select(*self.by, "o"))
                # a constant end is where the walk begins, so nothing else is built
                at = lambda token: None if token.startswith("?") else self.t.sparkSession.range(1).select(F.lit(self.term(token)).alias("node"))
                start = at(subject) if i == 0 else None
                end = at(obj) if i == len(path) - 1 and start is None else None
                if sign == "+":
                    part = patterns.plus(self.t, self.term(name), s, o, start, end, self.by)
                elif sign == "*":
                    part = patterns.star(self.t, self.term(name), s, o, nodes, start, end, self.by)
                else:
                    part = patterns.maybe(self.t, self.term(name), s, o, nodes, start, end, self.by)
            else:
                part = patterns.triple(self.t, self.term(name), s, o, self.by)
            df = part if df is None else patterns.both(df, part)
        for end, token in ((ends[0], subject), (ends[-1], obj)):
            if token.startswith("?"):
                df = df.where(F.col(token[1:]) == F.col(end)).drop(end) if token[1:] in df.columns else df.withColumnRenamed(end, token[1:])
            else:
                df = df.where(F.col(end) == self.term(token)).drop(end)
        return df.drop(*[c for c in ends[1:-1] if c in df.columns])

    # expressions
    def disjunction(self) -> Column:
        out = self.conjunction()
        while self.take("||") or self.take("OR"):
            out = out | self.conjunction()
        return out

    def conjunction(self) -> Column:
        out = self.comparison()
        while self.take("&&") or self.take("AND"):
            out = out & self.comparison()
        return out

    def comparison(self) -> Column:
        if self.take("!"):
            return ~self.comparison()
        if self.take("("):
            out = self.disjunction()
            self.next(")")
            return out
        left = self.value()
        sign = self.peek()
        if sign not in ("=", "!=", "<", ">", "<=", ">="):
            return left
        self.next()
        right = self.value()
        return {"=": left == right, "!=": left != right, "<": left < right, ">": left > right, "<=": left <= right, ">=": left >= right}[sign]

    def value(self) -> Column:
        token = self.next()
        if token.startswith("?"):
            return F.col(token[1:])
        if token.upper() in FUNCTIONS:
            self.next("(")
            inner = self.value()
            self.next(")")
            return FUNCTIONS[token.upper()](F.to_date(inner)).cast("long")
        return F.lit(int(token)) if token.isdigit() else F.lit(self.term(token))


def sparql(triples: DataFrame, text: str) -> DataFrame:
    return Query(triples, text).run()


def deleted(store: DataFrame, text: str, given: DataFrame | None = None, graph: str | None = None) -> DataFrame:
    """The triples (s, p, o), with ``graph`` in front, that ``DELETE { template } WHERE { group }`` takes out of the store.

    ``given`` are values for some variables, one row for each entity, so one job
    deletes for all of them. A row of the template with an unbound variable names
    nothing; a group without solutions deletes nothing. With ``graph`` every
    graph is matched apart.
    """
    found = Query(store, text, graph)
    doomed = found.update(given)
    return doomed.join(found.all, doomed.columns, "left_semi").distinct()


def update(store: DataFrame, text: str, given: DataFrame | None = None, graph: str | None = None, column: str = "month") -> DataFrame:
    """The store without what the text deletes; rows keep all their columns. WITH <name> deletes in that graph of ``column`` alone."""
    query = Query(store, text, graph)
    doomed = query.update(given)
    if not query.named:
        return store.join(doomed, doomed.columns, "left_anti").select(*store.columns)
    doomed = doomed.select("s", "p", "o").withColumn(column, F.lit(query.named[0]))
    return store.join(doomed, [column, "s", "p", "o"], "left_anti").select(*store.columns)


def sparql_by_graph(triples: DataFrame, text: str, graph: str = "month") -> DataFrame:
    """The query's solutions in each graph apart, with the graph's name before the variables; a join or a path never leaves its graph.

    All graphs are evaluated in one plan: the name is one more join and grouping key.
    """
    return Query(triples, text, graph).run()
