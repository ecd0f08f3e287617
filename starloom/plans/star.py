"""The whole star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from starloom.plans import dims, facts
from starloom.session import run_concurrently

DIMENSIONS = ("dim_date", "dim_customers", "dim_products", "dim_seller", "dim_payments")
FACTS = ("fact_orders", "fact_order_items", "fact_payments", "fact_reviews")
TABLES = DIMENSIONS + FACTS
# the dimensions whose keys each fact looks up (dim_date only with date_lookup="exact")
FACT_DIMENSIONS = {"fact_orders": ("dim_customers",),
                   "fact_order_items": ("dim_products", "dim_seller"),
                   "fact_payments": ("dim_payments",)}


class Star(Mapping):
    """The nine tables, each built on first access and then reused.

    Dimensions with dense keys run one small materializing job when they are
    first built (see ``dense_key``); everything else stays lazy until an action.
    ``dimensions`` may hold tables already built or read back from storage;
    ``previous`` (the last published star) keeps surrogate keys stable across
    refreshes: known members keep their key, new ones are numbered after it.
    ``registries`` does the same from key registries (``operators.registry``),
    which also hold the members that are absent now.  ``infer_members`` adds
    inferred members for keys that facts use and dimensions lack, and the
    unknown member 0 (``operators.members``), so that no fact row is lost in a
    join to its dimensions.
    """

    def __init__(self, sources: dict[str, DataFrame], grain: str = "day",
                 include_shipping: bool = True, null_safe: bool = False,
                 date_lookup: str = "computed", num_buckets=None,
                 dimensions: dict[str, DataFrame] | None = None,
                 previous: dict[str, DataFrame] | None = None,
                 registries: dict[str, DataFrame] | None = None, infer_members: bool = False):
        self.sources = sources
        self.infer = infer_members
        self.opts = dict(grain=grain, include_shipping=include_shipping, null_safe=null_safe,
                         date_lookup=date_lookup, num_buckets=num_buckets)
        self._built: dict[str, DataFrame] = dict(dimensions or {})
        self.previous = dict(previous or {})
        self.registries = dict(registries or {})

    def _make(self, name: str) -> DataFrame:
        return self._builders(lambda dim: self[dim])[name]()

    def _builders(self, dim):
        """How each table is made; ``dim`` gives the dimensions that facts look up."""
        s, o, nb = self.sources, self.opts, self.opts["num_buckets"]
        pv = lambda dim: self.registries.get(dim, self.previous.get(dim))
        used = lambda source, key: [s[source].select(key)] if self.infer else None
        dd = (lambda: self["dim_date"]) if o["date_lookup"] == "exact" else (lambda: None)
        if o["date_lookup"] == "exact" and o["grain"] == "day" and "dim_date" not in self._built:
            raise ValueError("exact date lookups need a date dimension of grain='timestamp'")
        return {
            "dim_date": lambda: dims.build_dim_date(s, o["grain"], o["include_shipping"]),
            "dim_customers": lambda: dims.build_dim_customers(s["customers"], nb, pv("dim_customers"),
                                                              used("orders", "customer_id")),
            "dim_products": lambda: dims.build_dim_products(s["products"],
                                                            s.get("category_translation"),
                                                            num_buckets=nb,
                                                            previous=pv("dim_products"),
                                                            used=used("order_items", "product_id")),
            "dim_seller": lambda: dims.build_dim_seller(s["sellers"], nb, pv("dim_seller"),
                                                        used("order_items", "seller_id")),
            "dim_payments": lambda: dims.build_dim_payments(s["order_payments"], nb,
                                                            pv("dim_payments")),
            "fact_orders": lambda: facts.build_fact_orders(s["orders"], dim("dim_customers"),
                                                           o["null_safe"], o["date_lookup"], dd(),
                                                           0 if self.infer else None),
            "fact_order_items": lambda: facts.build_fact_order_items(
                s["order_items"], dim("dim_products"), dim("dim_seller"),
                null_safe=o["null_safe"], date_lookup=o["date_lookup"], dim_date=dd()),
            "fact_payments": lambda: facts.build_fact_payments(s["order_payments"],
                                                               dim("dim_payments"), o["null_safe"]),
            "fact_reviews": lambda: facts.build_fact_reviews(s["order_reviews"],
                                                             date_lookup=o["date_lookup"],
                                                             dim_date=dd()),
        }

    def fact(self, name: str, dimensions=()) -> DataFrame:
        """A fact with the keys of the named ``dimensions`` only: the others are
        neither built nor joined."""
        if name in self._built:
            return self._built[name]
        self.prepare(dimensions)
        return self._builders(lambda dim: self[dim] if dim in dimensions else None)[name]()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._built:
            self.prepare(FACT_DIMENSIONS.get(name, ()))
            self._built[name] = self._make(name)
        return self._built[name]

    def prepare(self, names=DIMENSIONS, parallel: int | None = None) -> None:
        """Build the named dimensions (a fact stands for the dimensions it
        looks up) not built yet; their dense-key jobs are independent, so they
        are submitted together."""
        wanted = [d for n in names for d in (FACT_DIMENSIONS.get(n, ()) if n in FACTS else (n,))]
        todo = [n for n in dict.fromkeys(wanted) if n in DIMENSIONS and n not in self._built]
        spark = next(iter(self.sources.values())).sparkSession if self.sources else None
        built = run_concurrently({n: (lambda n=n: self._make(n)) for n in todo}, parallel, spark)
        self._built.update(built)

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def build_dimensions(sources: dict[str, DataFrame], grain: str = "day",
                     include_shipping: bool = True, num_buckets=None,
                     previous: dict[str, DataFrame] | None = None,
                     parallel: int | None = None,
                     registries: dict[str, DataFrame] | None = None,
                     infer_members: bool = False) -> dict[str, DataFrame]:
    """The five dimensions.  Their dense-key jobs are independent, so they
    are submitted together (``parallel=1``: one after another)."""
    st = Star(sources, grain, include_shipping, num_buckets=num_buckets, previous=previous, registries=registries,
              infer_members=infer_members)
    st.prepare(DIMENSIONS, parallel)
    return {n: st[n] for n in DIMENSIONS}


def build_facts(sources: dict[str, DataFrame], dimensions: dict[str, DataFrame],
                null_safe: bool = False, date_lookup: str = "computed",
                names=FACTS, infer_members: bool = False) -> dict[str, DataFrame]:
    st = Star(sources, null_safe=null_safe, date_lookup=date_lookup, dimensions=dimensions, infer_members=infer_members)
    return {n: st[n] for n in names}


def table_groups(date_lookup: str = "computed") -> list[tuple[list[str], list[str]]]:
    """(dimensions, facts) that depend on each other: every fact with the
    dimensions it looks up, merged where they share one; a dimension no fact
    looks up, or a fact that looks up none, stands alone.  Different groups
    can be built and written at the same time."""
    groups: list[tuple[set, list]] = []
    for f in FACTS:
        ds = set(FACT_DIMENSIONS.get(f, ())) | ({"dim_date"} if date_lookup == "exact" else set())
        joined = [g for g in groups if g[0] & ds]
        for g in joined:
            groups.remove(g)
            ds |= g[0]
        groups.append((ds, [x for g in joined for x in g[1]] + [f]))
    used = set().union(*(g[0] for g in groups))
    groups += [({d}, []) for d in DIMENSIONS if d not in used]
    return [([d for d in DIMENSIONS if d in ds], fs) for ds, fs in groups]


def build_star(sources: dict[str, DataFrame], grain: str = "day", include_shipping: bool = True,
               null_safe: bool = False, date_lookup: str = "computed",
               num_buckets=None) -> dict[str, DataFrame]:
    """All nine tables.  For on-demand building use ``Star``; to build and
    persist in one go use ``starloom.sinks.write_star_tables``."""
    st = Star(sources, grain, include_shipping, null_safe, date_lookup, num_buckets)
    st.prepare()
    return {n: st[n] for n in TABLES}
