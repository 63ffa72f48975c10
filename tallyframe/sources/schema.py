"""Statement table schema: keys, account codes and their physical column names."""

from __future__ import annotations

PARTY = "party_id"
DATE = "data_date"
FLAG = "prev_financial_indicator"
KEYS = (PARTY, DATE)

# The 57 account codes of a yearly statement (all amounts), in plain string order.
ACCOUNT_CODES = (
    "A_1", "A_10", "A_11", "A_12", "A_13", "A_131", "A_132", "A_15", "A_150", "A_151",
    "A_17", "A_2", "A_22", "A_23", "A_231", "A_232", "A_24", "A_25", "A_253", "A_258",
    "A_26", "A_29", "Amortisman_ve_Itfa_Giderleri", "G_60", "G_600", "G_601", "G_602",
    "G_610", "G_611", "G_612", "G_62", "G_63", "G_642", "G_646", "G_656", "G_66", "G_690",
    "G_691", "G_692", "P_3", "P_30", "P_300", "P_32", "P_331", "P_34", "P_340", "P_35",
    "P_4", "P_40", "P_400", "P_42", "P_43", "P_431", "P_440", "P_47", "P_472", "P_5",
)

# Account code -> physical column name, for the 23 codes stored under a
# descriptive name. Codes not listed are stored under their own name.
PHYSICAL_NAMES = {
    "P_30": "financial_liability_30",
    "P_40": "financial_liability_40",
    "A_10": "liquid_asset_10",
    "A_1": "revolving_asset_1",
    "A_2": "fixed_asset_2",
    "G_62": "sales_cost_62",
    "P_32": "commercial_liability_32",
    "P_42": "commercial_liability_42",
    "P_43": "other_liability_43",
    "P_3": "short_term_foreign_resource_3",
    "P_5": "equities_5",
    "P_4": "long_term_foreign_resource_4",
    "A_15": "inventory_15",
    "A_26": "nontangible_asset_26",
    "A_25": "tangible_asset_25",
    "G_66": "financial_expense_66",
    "A_12": "commercial_receivable_12",
    "A_22": "commercial_receivable_22",
    "P_35": "annual_construction_payment_35",
    "P_34": "advanced_received_34",
    "A_17": "annual_construction_cost_17",
    "G_60": "gross_sales_60",
    "A_11": "security_11",
}

# History read before the first requested date, and the only closing month kept.
LOOKBACK_MONTHS = 29
CLOSING_MONTH = 12
