"""Report settings: every document type, site and name the reports depend on.

The defaults are the values of the trading company whose reports are rebuilt
here; a company with other codes passes its own :class:`ReportConfig`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Site:
    """A stock location: its source ids in the stock table and its warehouse names."""

    name: str
    stock_sources: tuple[int, ...]
    warehouses: tuple[str, ...] = ()
    # measure of the stock table that counts as reserved in the deals report
    deals_reserved: str = "customer_order_units"
    # companies whose open purchases are goods already lying at this site
    logistics_suppliers: tuple[str, ...] = ()
    # warehouse ids by which an item counts as seen here; by name when empty
    seen_warehouse_ids: tuple[int, ...] = ()


# Sites, their source ids, warehouse names and logistics companies.
DSV_COMPANY = "DSV AIR & SEA ΜΟΝΟΠΡΟΣΩΠΗ ΑΝΩΝΥΜΗ ΕΤΑΙΡΕΙΑ"
TQL_COMPANY = "TOTAL QUALITY LOGISTICS ΑΕ"
DREAM_CARGO_COMPANY = "DREAM CARGO SERVICES SRL"

OWN = Site(
    "own",
    (13, 19, 20, 39),
    ("Κεντρικός Παπαδά", "Κεντρικός Σολωμού", "Κεντρικός Πειραιά", "Κεντρικός Βουλιαγμένη"),
)
TQL = Site(
    "tql",
    (41,),
    ("Total Quality Logistic",),
    deals_reserved="supplier_order_units",
    logistics_suppliers=(TQL_COMPANY,),
)
DSV = Site("dsv", (43,), ("DSV",), logistics_suppliers=(DSV_COMPANY,), seen_warehouse_ids=(2050,))
DREAM_CARGO = Site("dc", (22,), ("Dream Cargo",), logistics_suppliers=(DREAM_CARGO_COMPANY,))
HUB = Site("hub", (42,), ("Skroutz",))
INCOMING = Site("inc", (18,))


@dataclass(frozen=True)
class ReportConfig:
    company: int = 1000
    item_kind: int = 51
    home_currency: int = 100

    # document sources and partner kinds
    purchase_source: int = 1251
    sales_source: int = 1351
    transfer_source: int = 1151
    supplier_kind: int = 12
    customer_kind: int = 13

    # Document types.
    excluded_purchase_type: int = 2020
    sales_types: tuple[int, ...] = (
        7061, 7062, 7063, 7064, 7066, 7067, 7068, 7070, 7071, 7072, 7073, 7074,
        7075, 7076, 7077, 7078, 7079, 7080, 7082, 7094, 7095, 7127, 7162, 7163,
        7201, 7203, 7205, 7207, 7209, 7210, 7211, 7213, 7297, 22111,
    )
    export_types: tuple[int, ...] = (7201, 7203, 7205, 7207)
    retail_purchase_types: tuple[int, ...] = (
        2061, 2062, 2066, 2069, 3261, 3262, 3263, 3264, 3267, 3268, 3269, 3270,
        3279, 3280, 3281, 3282, 3283, 3284,
    )
    deals_transfer_types: tuple[int, ...] = (2500,)
    site_transfer_types: tuple[int, ...] = (2500, 2501)
    open_transfer_states: tuple[int, ...] = (0, 2)
    pending_type: int = 7021
    pending_target_type: int = 201
    pending_excluded_origin: int = 6
    arrival_type_names: tuple[str, ...] = ("Παραγγελία Σε Προμηθευτή", "Packing list προμηθευτή")

    # where a purchase names its supplier, and a document its warehouse
    supplier_on_line: bool = False
    warehouse_on_line: bool = False

    # sites
    own: Site = OWN
    tql: Site = TQL
    dsv: Site = DSV
    dream_cargo: Site = DREAM_CARGO
    hub: Site = HUB
    incoming: Site = INCOMING
    incoming_key_prefix: str = "ID"

    # Names and name patterns of categories, makers and items.
    export_category_patterns: tuple[str, ...] = ("%EXP%",)
    retail_excluded_patterns: tuple[str, ...] = ("EXP%",)
    laptop_categories: tuple[str, ...] = (
        "Laptops & Smartphones",
        "Laptops",
        "Refurbished Laptops",
        "Outlet Laptops",
        "Used Laptops",
    )
    refurbished_patterns: tuple[str, ...] = ("%efurbi%",)
    refurbished_header_patterns: tuple[str, ...] = ("%efurbished%",)
    refurbished_header: str = "Refurbirshed"
    # the header as it would be spelt to sort with its rows
    refurbished_header_fixed: str = "Refurbished"
    refurbished_block_patterns: tuple[str, ...] = ("%efurbish%", "%efubish%")
    export_name_patterns: tuple[str, ...] = ("%EXP%",)
    deal_excluded_maker: str = "Apple"
    priority_categories: tuple[str, ...] = (
        "Exp Laptops",
        "Laptops",
        "Exp Tablets",
        "EXP Gaming Consoles",
        "Exp PCs",
        "Exp Monitors",
        "EXP Air Fryers",
        "EXP Blenders",
        "Exp Keyboards",
        "Exp Docking Stations",
        "Exp Network",
    )
    portable_patterns: tuple[str, ...] = ("%aptop%", "%ablet%")
    suggestion_excluded_makers: tuple[str, ...] = ("Sony", "Starlink")

    # thresholds and factors
    line_value_floor: float = 2500.0
    line_quantity_floor: float = 1.0
    year_cost_period: int = 1000
    item_year: int = 2025
    portable_minimum: int = 20
    other_minimum: int = 5
    own_store_factor: float = 1.5
    # precision of a suggestion; a need that does not fit raises
    need_precision: int = 6
    final_stock_floor: int = 1
    refurbished_floor: int = 5
    laptop_floor: int = 9

    @property
    def deals_sites(self) -> tuple[Site, ...]:
        return (self.own, self.tql, self.dream_cargo, self.dsv)

    @property
    def outside_sites(self) -> tuple[Site, ...]:
        return (self.dsv, self.tql, self.dream_cargo)

    @property
    def logistics_companies(self) -> tuple[str, ...]:
        return tuple(n for s in self.outside_sites for n in s.logistics_suppliers)

    def with_(self, **changes) -> "ReportConfig":
        return replace(self, **changes)
