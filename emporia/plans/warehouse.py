"""The model graph: staging -> core -> marts as lazily built DataFrames.

``Warehouse`` holds the raw inputs and builds each model on first use from
the models it depends on. Nothing is executed until an action runs: Catalyst
sees the whole chain and prunes columns, pushes filters to the scan and drops
joins whose columns are not used. After ``emporia.plans.build.materialize``
the persisted tables replace the lazy ones, so downstream models read
materialised core tables, as a warehouse build does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emporia.operators import core, marts, staging
from emporia.sources import testdata

# Build order of the persisted tables (each only depends on earlier ones).
CORE_TABLES = ("dim_products", "fct_order_items", "fct_orders", "dim_customers")
MART_TABLES = ("fct_deliveries", "fct_freight", "mrt_kpis_daily", "mrt_reviews", "order_payments")


SYNTH_TABLES = ("fct_order_items", "fct_deliveries", "mrt_kpis_daily_synth")


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame], *, currency: str = "BRL",
                 tables: dict[str, DataFrame] | None = None):
        self.raw = dict(raw)
        self.currency = currency
        self._models: dict[str, DataFrame] = dict(tables or {})
        self._persisted: set[str] = set(self._models)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, mode: str = "real", **kw) -> "Warehouse":
        """Raw tables derived from the test tables in the real or synthetic source schema."""
        if mode == "synth":
            from emporia.sources import synthetic

            return cls(synthetic.load_raw(spark, sf_dir), **kw)
        return cls(testdata.load_raw(spark, sf_dir), **kw)

    def replace(self, name: str, df: DataFrame, persisted: bool = True) -> None:
        """Use ``df`` (e.g. a materialised table) for model ``name`` from now on.

        Lazy models built earlier are dropped, so they are rebuilt on top of
        the persisted table the next time they are used.
        """
        if persisted:
            self._persisted.add(name)
        self._models = {k: v for k, v in self._models.items() if k in self._persisted}
        self._models[name] = df

    def rows_of(self, name: str) -> tuple[DataFrame, list]:
        """Model ``name`` as rows and the columns to select from them: what follows from a row's own
        columns is computed where it is stored, so that a shuffle on the way carries the base columns only."""
        if name in self._models:
            return self._models[name], list(self._models[name].columns)
        if name == "fct_order_items":
            return core.order_item_rows(self.stg_order_items, self.stg_orders), core.order_item_columns()
        if name == "fct_orders":
            return (core.order_rows(self.stg_orders, self.lines, self.payments_base),
                    core.order_fact_columns(self.currency))
        if name == "fct_freight":
            return marts.freight_rows(self.lane_coordinates), marts.freight_columns()
        return getattr(self, name), list(getattr(self, name).columns)

    def rows_in_months(self, name: str) -> tuple[DataFrame, list] | None:
        """``rows_of`` a model whose rows stand together by month, as they come from tables stored so; None for others."""
        if name == "fct_deliveries" and self.has("fct_orders"):
            return self.rows_of(name)
        if name == "fct_freight" and all(self.has(t) and "order_ym" in getattr(self, t).columns for t in ("fct_order_items", "fct_orders")):
            return marts.freight_rows(self._lanes(marts.month_parts(self.fct_orders))), marts.freight_columns()
        return None

    def buildable(self) -> tuple[str, ...]:
        """The persisted tables of the mode whose raw tables are at hand, in build order."""
        return CORE_TABLES + MART_TABLES if "raw_payments" in self.raw else SYNTH_TABLES

    def is_persisted(self, name: str) -> bool:
        return name in self._persisted

    def has(self, name: str) -> bool:
        """True when ``name`` is a persisted table (not a lazy model)."""
        return name in self._persisted

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "raw":
            raise AttributeError(name)
        models = self.__dict__["_models"]
        if name not in models:
            build = getattr(type(self), f"_build_{name}", None)
            if build is None:
                raise AttributeError(f"unknown model {name!r}")
            models[name] = build(self)
        return models[name]

    # ---- staging -------------------------------------------------------
    def _build_stg_orders(self):
        return staging.stg_orders(self.raw["raw_orders"], self.currency)

    def _build_stg_order_items(self):
        return staging.stg_order_items(self.raw["raw_order_items"])

    def _build_stg_customers(self):
        return staging.stg_customers(self.raw["raw_customers"])

    def _build_stg_sellers(self):
        return staging.stg_sellers(self.raw["raw_sellers"])

    def _build_stg_products(self):
        return staging.stg_products(self.raw["raw_products"])

    def _build_stg_payments(self):
        return staging.stg_payments(self.raw["raw_payments"])

    def _build_payments_base(self):
        return staging.payments_base(self.raw["raw_payments"])

    def _build_stg_reviews(self):
        return staging.stg_reviews(self.raw["raw_reviews"])

    def _build_stg_refunds(self):
        return staging.stg_refunds(self.raw["raw_refunds"])

    def _build_stg_marketing_spend(self):
        return staging.stg_marketing_spend(self.raw["raw_marketing_spend"])

    def _build_stg_geolocation(self):
        return staging.stg_geolocation(self.raw["raw_geolocation"])

    def _build_geo_centroids(self):
        return staging.geo_centroids(self.stg_geolocation)

    # ---- core ----------------------------------------------------------
    def _build_dim_customers(self):
        # persisted fct_orders carries every stg_orders column the dimension reads
        orders = self.fct_orders if self.has("fct_orders") else self.stg_orders
        return core.dim_customers(self.stg_customers, orders)

    def _build_dim_products(self):
        return core.dim_products(self.stg_products)

    def _build_fct_order_items(self):
        rows, columns = self.rows_of("fct_order_items")
        return rows.select(*columns)

    def _build_order_item_totals(self):
        return core.order_item_totals(self.lines)

    def _build_order_payment_totals(self):
        return core.order_payment_totals(self.payments_base)

    def _build_orders_with_items(self):
        if self.has("fct_orders"):
            return self.fct_orders
        return core.orders_with_items(self.stg_orders, self.lines)

    def _build_fct_orders(self):
        rows, columns = self.rows_of("fct_orders")
        return rows.select(*columns)

    # ---- marts ---------------------------------------------------------
    def _build_lines(self):
        """Order lines: the persisted fact when there is one, else staging."""
        return self.fct_order_items if self.has("fct_order_items") else self.stg_order_items

    def _customers(self):
        return self.dim_customers if self.has("dim_customers") else self.stg_customers

    def _build_fct_deliveries(self):
        return marts.fct_deliveries(self.orders_with_items)

    def _lanes(self, months=None):
        return marts.lane_coordinates(
            self.lines, self.orders_with_items, self._customers(), self.stg_sellers, self.geo_centroids, months
        )

    def _build_lane_coordinates(self):
        return self._lanes()

    def _build_fct_freight(self):
        rows, columns = self.rows_of("fct_freight")
        return rows.select(*columns)

    def _build_mrt_kpis_daily(self):
        return marts.mrt_kpis_daily(self.orders_with_items)

    def _build_mrt_reviews(self):
        return marts.mrt_reviews(self.stg_reviews, self.orders_with_items)

    def _build_order_payments(self):
        from emporia.operators import payments

        return payments.order_payments(self.payments_base, self.orders_with_items)

    def _build_mrt_kpis_daily_synth(self):
        from emporia.operators import kpis

        return kpis.mrt_kpis_daily_synth(self.orders_with_items, self.stg_refunds, self.stg_marketing_spend)

    def _build_freight_pct_trend(self):
        return marts.freight_pct_trend(self.fct_freight)
