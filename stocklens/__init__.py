"""Stock and sales reporting for trading companies on Spark."""

from stocklens.config import ReportConfig, Site
from stocklens.plans.deals import deal_export, deal_report
from stocklens.plans.export import export_report
from stocklens.plans.retail import retail_category_share
from stocklens.plans.transfers import transfer_suggestions
from stocklens.sources.tables import Tables, load_catalog, load_jdbc, load_tables

__all__ = [
    "ReportConfig",
    "Site",
    "Tables",
    "deal_export",
    "deal_report",
    "export_report",
    "load_catalog",
    "load_jdbc",
    "load_tables",
    "retail_category_share",
    "transfer_suggestions",
]
