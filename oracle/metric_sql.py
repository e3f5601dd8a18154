"""SQL for the metric table: one CTE per step, one SELECT per branch."""

from __future__ import annotations

from oracle.loan_sql import AS_OF, FACT, MONTHS_BACK, a_month_ago, before_voids, day

MONTH = f"date_trunc('month', {AS_OF})::DATE"
DAYS_LEFT = f"date_diff('day', {AS_OF} - 1, last_day({AS_OF}))"

# The metric names, the status codes and which metric a status counts for.
SEEN = "('New', 'React', 'Paid_D', 'Default_P', 'Default_M', 'Default_C', 'Paid_P', 'PaidRel_1', 'PaidRel_2', 'Renewed_1', 'Renewed_2', 'Due')"
EVENTS = "('New', 'React', 'Paid_D', 'Default_P', 'Default_M', 'Default_C', 'Paid_P', 'PaidRel_1', 'PaidRel_2', 'Renewed_1', 'Renewed_2', 'Due', 'Charged off', 'Bankrupt')"
DEFAULTS = "('Default_P', 'Default_M', 'Default_C')"
OPEN = "('Active', 'Collections', 'Collections_M')"
NAMED = """CASE status WHEN 'New' THEN 'New' WHEN 'React' THEN 'Reactivated' WHEN 'Paid_D' THEN 'Paid Off'
  WHEN 'Paid_P' THEN 'Paid Off after Default' WHEN 'Default_C' THEN 'Default (Charges)' WHEN 'Due' THEN 'Due'
  WHEN 'Default_P' THEN 'Default (Principal)' WHEN 'Default_M' THEN 'Default (Principal)'
  WHEN 'Charged off' THEN 'Charged Off' WHEN 'Bankrupt' THEN 'Charged Off' ELSE 'Reloaned' END"""

def opens_after(months_back: int) -> str:
    return f"last_day({AS_OF} - INTERVAL {months_back} MONTH)"


PLACED = """placed AS MATERIALIZED (
  SELECT f.*, s.unit, s.product, s.region,
         CASE WHEN s.unit = 'Online' AND s.product = 'Mini Money' THEN ' ' ELSE s.province END AS province,
         CASE WHEN s.unit = 'Online' AND s.product = 'Mini Money' THEN ' ' ELSE s.store_name END AS place,
         CASE WHEN f.status = 'Active' THEN 'Active' ELSE 'Collections' END AS cls
  FROM fact f JOIN store s USING (store_id)
),
months AS (
  SELECT DISTINCT date_trunc('month', d)::DATE AS m
  FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2003-12-31', INTERVAL 1 DAY))::DATE AS d)
  WHERE d > %s AND d <= %s
)"""

COUNTS = "count(DISTINCT ssn)::DECIMAL(21,3) AS vc, count(DISTINCT appl)::DECIMAL(21,3) AS vl"

RATIOS = {
    "Default (Principal)": ["Active BOM"],
    "Paid Off": ["Active BOM"],
    "Reactivated": ["Active BOM"],
    "New": ["Active BOM"],
    "Reloaned": ["Active BOM", "New", "Reactivated"],
    "Charged Off": ["Collections BOM"],
    "Default (Any)": ["Collections BOM"],
    "Paid Off after Default": ["Collections BOM"],
}


def total(value: str, *metrics: str) -> str:
    names = ", ".join(f"'{m}'" for m in metrics)
    return f"sum(CASE WHEN metric IN ({names}) THEN {value} ELSE 0 END)"


def both(*metrics: str) -> list[str]:
    return [*metrics, *[m + " Proj" for m in metrics]]


def divided(top: str, bottom: str) -> str:
    return f"(({top}) / nullif({bottom}, 0))::DECIMAL(28,7)"


class MetricSql:
    """Branches of one metric set; `sub` adds the sub-product to the dimensions."""

    def __init__(self, name: str, months_back: int = MONTHS_BACK):
        self.opens = opens_after(months_back)
        self.v2 = name.startswith("v2")
        self.mini_only = name == "v2"
        self.sub = self.v2
        self.dims = ["unit", "product", *(["sub"] if self.sub else []), "region", "province", "place"]
        self.churn_base = ["Active BOM", "New"] if self.v2 else ["Active BOM"]
        self.churn_base_proj = [*self.churn_base, "New Proj"] if self.v2 else ["Active BOM"]

    def row(self, source: str, metric: str, dateref: str, values: str, where: str, product="product", counted_to="NULL::DATE"):
        dims = ", ".join(f"{product} AS product" if d == "product" else d for d in self.dims)
        return (
            f"SELECT {dims}, {metric} AS metric, {dateref} AS dateref, {values}, {counted_to} AS counted_to "
            f"FROM {source} WHERE {where} GROUP BY ALL"
        )

    # -- base ---------------------------------------------------------------------------------

    def bom(self, mini=False):
        return self._snap("m", "BOM", mini)

    def eom(self, mini=False):
        return self._snap("(m + INTERVAL 1 MONTH)", "EOM", mini)

    def _open(self, alias: str, at: str) -> str:
        return f"{alias}.status IN {OPEN} AND {alias}.d1 < {at} AND {alias}.d2 >= {at}"

    def _mini(self, at: str) -> tuple[str, str]:
        elsewhere = "o.product IN ('Zip', 'Pocket Money', 'Thurlow')"
        if at == AS_OF:
            seen = f"(f.ssn, f.cls) NOT IN (SELECT o.ssn, o.cls FROM placed o WHERE {elsewhere} AND {self._open('o', at)})"
        else:
            then = at.replace("m", "k.m", 1)
            seen = (
                "(f.ssn, f.cls, months.m) NOT IN (SELECT o.ssn, o.cls, k.m FROM placed o, months k "
                f"WHERE {elsewhere} AND {self._open('o', then)})"
            )
        return f"AND f.product = 'Mini Money' AND {seen}", "'Mini Money Only'"

    def _snap(self, at: str, kind: str, mini: bool) -> str:
        extra, product = self._mini(at) if mini else ("", "product")
        return self.row(
            "placed f, months", f"cls || ' {kind}'", "m", COUNTS, f"{self._open('f', at)} {extra}", product
        )

    def eom_zero(self):
        zero = "0::DECIMAL(21,3) AS vc, 0::DECIMAL(21,3) AS vl"
        return self.row("placed f", "cls || ' EOM'", MONTH, zero, f"status IN {OPEN}")

    def eom_to_date(self, mini=False):
        extra, product = self._mini(AS_OF) if mini else ("", "product")
        return self.row(
            "placed f", "cls || ' EOM'", MONTH, COUNTS, f"{self._open('f', AS_OF)} {extra}", product, f"{AS_OF} - 1"
        )

    def flows(self, any_default=False, mini=False):
        wanted = DEFAULTS if any_default else EVENTS
        where = f"status IN {wanted} AND d1 > {self.opens} AND d2 < {AS_OF}"
        product = "product"
        if mini:
            product = "'Mini Money Only'"
            where += (
                " AND f.product = 'Mini Money' AND (f.ssn, last_day(f.d1)) NOT IN (SELECT o.ssn, last_day(o.d1) FROM placed o "
                f"WHERE o.status IN {SEEN} AND o.product IN ('Zip', 'Pocket Money', 'Thurlow'))"
            )
        elif not any_default:
            where += " AND product IS NOT NULL"
        metric = "'Default (Any)'" if any_default else NAMED
        return self.row("placed f", metric, "date_trunc('month', d1)::DATE", COUNTS, where, product, "max(d2)")

    def base(self, mini=False) -> str:
        key = " AND ".join(f"n.{d} IS NOT DISTINCT FROM b.{d}" for d in [*self.dims, "metric", "dateref"])
        current = self.eom_to_date(mini) if self.v2 else self.eom_zero()
        return (
            f"SELECT * FROM ({self.bom(mini)}\nUNION ALL\n{self.eom(mini)}) b "
            f"WHERE NOT EXISTS (SELECT 1 FROM ({current}) n WHERE {key})\nUNION ALL\n{current}\nUNION ALL\n"
            f"{self.flows(False, mini)}\nUNION ALL\n{self.flows(True, mini)}"
        )

    # -- derived ------------------------------------------------------------------------------

    def levels(self) -> list[tuple[str, str, list[str]]]:
        found = [
            ("", "unit <> ' '", ["unit", "product"]),
            (" Pocket Zip", "product IN ('Zip', 'Pocket Money')", []),
            (" Mini", "product = 'Mini Money'", []),
        ]
        if self.sub:
            found.append((" Sub", "unit <> ' ' AND product = 'Zip' AND sub <> ' '", ["unit", "product", "sub"]))
        return found

    MINI_LEVEL = [(" Mini Only", "product = 'Mini Money Only'", [])]

    def leveled(self, name: str, value, source: str, at_levels, tail="", loans=False, where="TRUE") -> list[str]:
        out = []
        for suffix, takes, keeps in at_levels:
            dims = ", ".join(d if d in keeps else f"' ' AS {d}" for d in self.dims)
            vl = f"{value('vl')}::DECIMAL(21,3)" if loans else "NULL::DECIMAL(21,3)"
            group = ", ".join([*keeps, "dateref"])
            out.append(
                f"SELECT {dims}, '{name}{suffix}{tail}' AS metric, dateref, {value('vc')}::DECIMAL(21,3) AS vc, {vl} AS vl, "
                f"NULL::DATE AS counted_to FROM {source} WHERE {takes} AND {where} GROUP BY {group}"
            )
        return out

    def stored(self, name: str, value, source: str, loans=False, where="TRUE") -> str:
        dims = ", ".join(self.dims)
        vl = f"({value('vl')})::DECIMAL(21,3)" if loans else "NULL::DECIMAL(21,3)"
        return (
            f"SELECT {dims}, '{name}' AS metric, dateref, ({value('vc')})::DECIMAL(21,3) AS vc, {vl} AS vl, "
            f"NULL::DATE AS counted_to FROM {source} WHERE region <> ' ' AND {where} GROUP BY {dims}, dateref"
        )

    def ratio(self, metric: str, source: str, at_levels=None, loans=None) -> list[str]:
        loans = self.v2 if loans is None else loans
        return self.leveled(
            f"{metric} Pct", lambda v: divided(total(v, metric), total(v, *RATIOS[metric])), source,
            at_levels or self.levels(), loans=loans,
        )

    @staticmethod
    def active_calc(v):
        return (
            f"{total(v, 'Active BOM')} - {total(v, 'Default (Principal)')} - {total(v, 'Paid Off')} "
            f"+ {total(v, 'Reactivated')} + {total(v, 'New')}"
        )

    @staticmethod
    def coll_calc(v):
        return (
            f"{total(v, 'Collections BOM')} + {total(v, 'Default (Any)')} "
            f"- {total(v, 'Paid Off after Default')} - {total(v, 'Charged Off')}"
        )

    @staticmethod
    def gap(observed, calc):
        return lambda v: f"CASE WHEN {total(v, observed)} = 0 THEN 0 ELSE {total(v, observed)} - ({calc(v)}) END"

    def roll(self, which: str, source: str) -> str:
        formula = {
            "Active EOM Calculated": self.active_calc,
            "Active EOM Delta": self.gap("Active EOM", self.active_calc),
            "Collections EOM Calculated": self.coll_calc,
            "Collections EOM Delta": self.gap("Collections EOM", self.coll_calc),
        }[which]
        return self.stored(which, formula, source, self.v2)

    ROLLS = ["Active EOM Calculated", "Active EOM Delta", "Collections EOM Calculated", "Collections EOM Delta"]

    def derived(self, source: str) -> list[str]:
        return [b for m in RATIOS for b in self.ratio(m, source)] + [self.roll(w, source) for w in self.ROLLS]

    def derived_mini(self, source: str) -> list[str]:
        return [b for m in RATIOS for b in self.ratio(m, source, self.MINI_LEVEL, False)]

    # -- churn --------------------------------------------------------------------------------

    @staticmethod
    def gross(v):
        return f"{total(v, 'Paid Off', 'Default (Principal)')} - {total(v, 'Active EOM Delta')}"

    def net(self, v):
        return f"{self.gross(v)} - {total(v, 'Reactivated')}"

    def churn_abs(self, name: str, source: str) -> str:
        return self.stored(name, self.gross if name == "Gross Churn" else self.net, source)

    def churn_pct(self, name: str, source: str, at_levels=None, base=None) -> list[str]:
        top = self.gross if name.startswith("Gross") else self.net
        base = base or self.churn_base
        return self.leveled(name, lambda v: divided(top(v), total(v, *base)), source, at_levels or self.levels())

    def churn(self, source: str) -> list[str]:
        return [
            self.churn_abs("Gross Churn", source), self.churn_abs("Net Churn", source),
            *self.churn_pct("Gross Churn Pct", source), *self.churn_pct("Net Churn Pct", source),
        ]

    def churn_mini(self, source: str) -> list[str]:
        return [
            b for n in ("Gross Churn Pct", "Net Churn Pct") for b in self.churn_pct(n, source, self.MINI_LEVEL, ["Active BOM"])
        ]

    # -- projections --------------------------------------------------------------------------

    def flow_proj(self, any_default=False, mini=False) -> str:
        wanted = DEFAULTS if any_default else EVENTS
        where = f"status IN {wanted} AND product IS NOT NULL AND d1 > {AS_OF} - 31 AND d2 < {AS_OF}"
        product = "product"
        if mini:
            product = "'Mini Money Only'"
            where += (
                f" AND f.product = 'Mini Money' AND f.ssn NOT IN (SELECT o.ssn FROM placed o WHERE o.status IN {SEEN} "
                f"AND o.product IN ('Zip', 'Pocket Money') AND o.d1 >= {MONTH} AND o.d1 <= last_day({AS_OF}))"
            )
        metric = "'Default (Any) Proj'" if any_default else f"{NAMED} || ' Proj'"
        values = ", ".join(
            f"(count(DISTINCT {c}) * {DAYS_LEFT} / 30.0)::DECIMAL(28,4)::DECIMAL(21,3) AS {n}"
            for c, n in (("ssn", "vc"), ("appl", "vl"))
        )
        return self.row("placed f", metric, MONTH, values, where, product)

    def delta_proj(self, metric: str, source: str) -> str:
        dims = ", ".join(self.dims)
        return (
            f"SELECT {dims}, '{metric} Proj' AS metric, {MONTH} AS dateref, avg(vc)::DECIMAL(28,7)::DECIMAL(21,3) AS vc, "
            f"NULL::DECIMAL(21,3) AS vl, NULL::DATE AS counted_to FROM {source} WHERE metric = '{metric}' "
            f"AND dateref < {MONTH} AND dateref > last_day({AS_OF} - INTERVAL 6 MONTH) GROUP BY {dims}"
        )

    def projection(self, source: str) -> list[str]:
        return [
            self.flow_proj(False), self.flow_proj(True),
            self.delta_proj("Active EOM Delta", source), self.delta_proj("Collections EOM Delta", source),
        ]

    def projection_mini(self, source: str) -> list[str]:
        return [self.flow_proj(False, True), self.flow_proj(True, True)]

    NOW = f"dateref = {MONTH}"

    @staticmethod
    def gross_proj(v):
        return f"{total(v, 'Paid Off Proj', 'Default (Principal) Proj')} - {total(v, 'Active EOM Delta Proj')}"

    def net_proj(self, v):
        return f"{self.gross_proj(v)} - {total(v, 'Reactivated Proj')}"

    def churn_abs_proj(self, name: str, source: str) -> str:
        return self.stored(
            name, self.gross_proj if name.startswith("Gross") else self.net_proj, source, where=self.NOW
        )

    def churn_pct_proj(self, name: str, source: str, at_levels=None, base=None) -> list[str]:
        base = base or self.churn_base_proj

        def top(v):
            gross = f"{total(v, *both('Paid Off', 'Default (Principal)'))} - {total(v, 'Active EOM Delta Proj')}"
            return gross if name.startswith("Gross") else f"{gross} - {total(v, *both('Reactivated'))}"

        return self.leveled(
            name, lambda v: divided(top(v), total(v, *base)), source, at_levels or self.levels(), " Proj", where=self.NOW
        )

    def churn_proj(self, source: str) -> list[str]:
        return [
            self.churn_abs_proj("Gross Churn Proj", source), self.churn_abs_proj("Net Churn Proj", source),
            *self.churn_pct_proj("Gross Churn Pct", source), *self.churn_pct_proj("Net Churn Pct", source),
        ]

    def churn_proj_mini(self, source: str) -> list[str]:
        return [
            b
            for n in ("Gross Churn Pct", "Net Churn Pct")
            for b in self.churn_pct_proj(n, source, self.MINI_LEVEL, ["Active BOM"])
        ]

    def ratio_proj(self, metric: str, source: str, at_levels=None) -> list[str]:
        opening = [m for m in RATIOS[metric] if m.endswith("BOM")]
        base = opening + both(*[m for m in RATIOS[metric] if m not in opening])
        return self.leveled(
            f"{metric} Pct", lambda v: divided(total(v, *both(metric)), total(v, *base)), source,
            at_levels or self.levels(), " Proj", where=self.NOW,
        )

    def closing_one(self, which: str, source: str) -> str:
        def delta(v, m):
            return total(v, m + " Proj") if self.v2 else total(v, *both(m))

        def active(v):
            return (
                f"{total(v, 'New Proj', 'Reactivated Proj')} - {total(v, 'Default (Principal) Proj', 'Paid Off Proj')}"
            )

        def coll(v):
            return f"{total(v, 'Default (Any) Proj')} - {total(v, 'Paid Off after Default Proj', 'Charged Off Proj')}"

        formula = {
            "Active EOM Calculated Proj": active,
            "Active EOM Proj": lambda v: f"{self.active_calc(v)} + {active(v)} + {delta(v, 'Active EOM Delta')}",
            "Collections EOM Calculated Proj": coll,
            "Collections EOM Proj": lambda v: f"{self.coll_calc(v)} + {coll(v)} + {delta(v, 'Collections EOM Delta')}",
        }[which]
        return self.stored(which, formula, source, where=self.NOW)

    CLOSINGS = ["Active EOM Calculated Proj", "Active EOM Proj", "Collections EOM Calculated Proj", "Collections EOM Proj"]

    def closing(self, source: str) -> list[str]:
        return [b for m in RATIOS for b in self.ratio_proj(m, source)] + [
            self.closing_one(w, source) for w in self.CLOSINGS
        ]

    def closing_mini(self, source: str) -> list[str]:
        return [b for m in RATIOS for b in self.ratio_proj(m, source, self.MINI_LEVEL)]

    # -- whole steps --------------------------------------------------------------------------

    def steps(self):
        pairs = [
            ("base", lambda s: [self.base()], lambda s: [self.base(True)]),
            ("derived", self.derived, self.derived_mini),
            ("churn", self.churn, self.churn_mini),
            ("projection", self.projection, self.projection_mini),
            ("churn_projected", self.churn_proj, self.churn_proj_mini),
            ("closing", self.closing, self.closing_mini),
        ]
        for name, plain, mini in pairs:
            yield name, plain
            if self.mini_only:
                yield f"{name}_mini_only", mini

    def out(self) -> str:
        names = {
            "unit": "Business_Unit", "product": "Product", "sub": "Subproduct",
            "region": "Region", "province": "Province", "place": "Store",
        }
        return (
            ", ".join(f"{d} AS {names[d]}" for d in self.dims)
            + ", metric AS Metric, "
            + day("dateref", "Dateref")
            + ", vc::DOUBLE AS Value_Cust, vl::DOUBLE AS Value_Loan, "
            + day("counted_to", "AsOf_Date")
        )

    def upto(self, step: str | None) -> tuple[str, str]:
        """CTEs that build the stored rows before `step`, and the name of the last one."""
        ctes, last = [f"WITH {FACT},\n{PLACED % (self.opens, AS_OF)}"], "none"
        for i, (name, build) in enumerate(self.steps()):
            if name == step:
                break
            rows = "\nUNION ALL\n".join(build(last))
            before = f"SELECT * FROM {last}\nUNION ALL\n" if i else ""
            ctes.append(f"t{i} AS MATERIALIZED (\n{before}{rows}\n)")
            last = f"t{i}"
        return ",\n".join(ctes), last

    def query(self, step: str | None, branches) -> str:
        """Branches of one step, evaluated over the rows stored before it."""
        ctes, last = self.upto(step)
        found = branches(last)
        body = "\nUNION ALL\n".join([found] if isinstance(found, str) else found)
        return f"{ctes}\nSELECT {self.out()} FROM (\n{body}\n)"

    def whole(self) -> str:
        ctes, last = self.upto(None)
        return f"{ctes}\nSELECT {self.out()} FROM {last}"

    def second(self) -> str:
        """The rows after two runs: last month's, and today's over what that one stored."""
        ctes, last = self.upto(None)
        old = before_voids(a_month_ago(f"{ctes}\nSELECT * FROM {last} WHERE metric NOT LIKE '%Proj'"))
        parts = [f"WITH old AS MATERIALIZED (SELECT * FROM ({old})),\n{FACT},\n{PLACED % (self.opens, AS_OF)}"]
        key = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in [*self.dims, "metric", "dateref"])
        columns = ", ".join(f"n.{c}" for c in [*self.dims, "metric", "dateref", "vc", "vl"])
        last = "old"
        for i, (name, build) in enumerate(self.steps()):
            rows = "\nUNION ALL\n".join(build(last))
            new = "SELECT * FROM fresh n"
            if not name.startswith("base"):  # derived rows keep the stored day
                new = f"SELECT {columns}, o.counted_to FROM fresh n LEFT JOIN old o ON {key}"
            parts.append(
                f"t{i} AS MATERIALIZED (\nWITH fresh AS MATERIALIZED ({rows})\n{new} UNION ALL "
                f"SELECT * FROM {last} o WHERE NOT EXISTS (SELECT 1 FROM fresh n WHERE {key})\n)"
            )
            last = f"t{i}"
        return ",\n".join(parts) + f"\nSELECT {self.out()} FROM {last}"
