"""Locale profiles for settlement reports, held as data.

A profile says how one market writes its report: how header names are
normalized, which localized header maps to which canonical column, how
localized month names read in English, which date-time patterns to try (in
order) and which number style the money columns use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# These must equal the source reports' vocabulary exactly.
# --------------------------------------------------------------------------

# Canonical column order of a clean transaction table (33 columns).
CANONICAL_COLUMNS = [
    "date", "time", "weekday", "settlement_id", "type", "order_id", "sku", "ASIN",
    "description", "quantity", "marketplace", "account_type", "fulfillment",
    "order_city", "order_state", "order_postal", "tax_collection_model",
    "product_sales", "product_sales_tax", "shipping_credits", "shipping_credits_tax",
    "gift_wrap_credits", "giftwrap_credits_tax", "Regulatory_Fee", "Tax_On_Regulatory_Fee",
    "promotional_rebates", "promotional_rebates_tax", "marketplace_withheld_tax",
    "selling_fees", "fba_fees", "other_transaction_fees", "other", "total",
]

# Numeric columns of the US reports (quantity and 16 money columns).
NUMERIC_COLUMNS_US = [
    "quantity", "product_sales", "product_sales_tax", "shipping_credits",
    "shipping_credits_tax", "gift_wrap_credits", "giftwrap_credits_tax", "Regulatory_Fee",
    "Tax_On_Regulatory_Fee", "promotional_rebates", "promotional_rebates_tax",
    "marketplace_withheld_tax", "selling_fees", "fba_fees", "other_transaction_fees",
    "other", "total",
]

# Numeric columns of the EU reports (no regulatory fee columns).
NUMERIC_COLUMNS_EU = [
    "quantity", "product_sales", "product_sales_tax", "shipping_credits",
    "shipping_credits_tax", "gift_wrap_credits", "giftwrap_credits_tax",
    "promotional_rebates", "promotional_rebates_tax", "marketplace_withheld_tax",
    "selling_fees", "fba_fees", "other_transaction_fees", "other", "total",
]

# Columns removed by the short daily extract (the helper column included).
DAILY_EXTRACT_DROP = [
    "product_sales_tax", "shipping_credits", "shipping_credits_tax", "gift_wrap_credits",
    "giftwrap_credits_tax", "Regulatory_Fee", "Tax_On_Regulatory_Fee", "promotional_rebates",
    "promotional_rebates_tax", "marketplace_withheld_tax", "data_time",
]

# Keep list of the short daily extract, in its order.
DAILY_EXTRACT_KEEP = [
    "date", "time", "weekday", "settlement_id", "type", "order_id", "sku", "ASIN",
    "description", "quantity", "marketplace", "account_type", "fulfillment", "order_city",
    "order_state", "order_postal", "tax_collection_model", "other_transaction_fees",
    "product_sales_tax", "shipping_credits", "shipping_credits_tax", "gift_wrap_credits",
    "giftwrap_credits_tax", "Regulatory_Fee", "Tax_On_Regulatory_Fee", "promotional_rebates",
    "promotional_rebates_tax", "marketplace_withheld_tax", "other", "product_sales", "total",
]

# Normalized German header -> canonical column.
HEADERS_DE = {
    "Datum_Uhrzeit": "date_time",
    "Abrechnungsnummer": "settlement_id",
    "Typ": "type",
    "Bestellnummer": "order_id",
    "SKU": "sku",
    "Beschreibung": "description",
    "Menge": "quantity",
    "Marketplace": "marketplace",
    "Versand": "fulfillment",
    "Ort_der_Bestellung": "order_city",
    "Bundesland": "order_state",
    "Postleitzahl": "order_postal",
    "Steuererhebungsmodell": "tax_collection_model",
    "Umsätze": "product_sales",
    "Produktumsatzsteuer": "product_sales_tax",
    "Gutschrift_für_Versandkosten": "shipping_credits",
    "Steuer_auf_Versandgutschrift": "shipping_credits_tax",
    "Gutschrift_für_Geschenkverpackung": "gift_wrap_credits",
    "Steuer_auf_Geschenkverpackungsgutschriften": "giftwrap_credits_tax",
    "Rabatte_aus_Werbeaktionen": "promotional_rebates",
    "Steuer_auf_Aktionsrabatte": "promotional_rebates_tax",
    "Einbehaltene_Steuer_auf_Marketplace": "marketplace_withheld_tax",
    "Verkaufsgebühren": "selling_fees",
    "Gebühren_zu_Versand_durch_Amazon": "fba_fees",
    "Andere_Transaktionsgebühren": "other_transaction_fees",
    "Andere": "other",
    "Gesamt": "total",
}

# Normalized Italian header -> canonical column.
HEADERS_IT = {
    "data_ora": "date_time",
    "numero_pagamento": "settlement_id",
    "tipo": "type",
    "numero_ordine": "order_id",
    "sku": "sku",
    "descrizione": "description",
    "quantità": "quantity",
    "marketplace": "marketplace",
    "gestione": "fulfillment",
    "città_di_provenienza_dell'ordine": "order_city",
    "provincia_di_provenienza_dell'ordine": "order_state",
    "cap_dell'ordine": "order_postal",
    "modello_di_riscossione_delle_imposte": "tax_collection_model",
    "vendite": "product_sales",
    "imposta_sulle_vendite_dei_prodotti": "product_sales_tax",
    "accrediti_per_le_spedizioni": "shipping_credits",
    "imposta_accrediti_per_le_spedizioni": "shipping_credits_tax",
    "accrediti_per_confezioni_regalo": "gift_wrap_credits",
    "imposta_sui_crediti_confezione_regalo": "giftwrap_credits_tax",
    "sconti_promozionali": "promotional_rebates",
    "imposta_sugli_sconti_promozionali": "promotional_rebates_tax",
    "trattenuta_iva_del_marketplace": "marketplace_withheld_tax",
    "commissioni_di_vendita": "selling_fees",
    "costi_del_servizio_logistica_di_amazon": "fba_fees",
    "altri_costi_relativi_alle_transazioni": "other_transaction_fees",
    "altro": "other",
    "totale": "total",
}

# Normalized Spanish header -> canonical column.
HEADERS_ES = {
    "fecha_y_hora": "date_time",
    "identificador_de_pago": "settlement_id",
    "tipo": "type",
    "número_de_pedido": "order_id",
    "sku": "sku",
    "descripción": "description",
    "cantidad": "quantity",
    "web_de_amazon": "marketplace",
    "gestión_logística": "fulfillment",
    "ciudad_de_procedencia_del_pedido": "order_city",
    "comunidad_autónoma_de_procedencia_del_pedido": "order_state",
    "código_postal_de_procedencia_del_pedido": "order_postal",
    "formulario_de_recaudación_de_impuestos": "tax_collection_model",
    "ventas_de_productos": "product_sales",
    "impuesto_de_ventas_de_productos": "product_sales_tax",
    "abonos_de_envío": "shipping_credits",
    "impuestos_por_abonos_de_envío": "shipping_credits_tax",
    "abonos_de_envoltorio_para_regalo": "gift_wrap_credits",
    "impuestos_por_abonos_de_envoltorio_para_regalo": "giftwrap_credits_tax",
    "devoluciones_promocionales": "promotional_rebates",
    "impuestos_de_descuentos_por_promociones": "promotional_rebates_tax",
    "impuesto_retenido_en_el_sitio_web": "marketplace_withheld_tax",
    "tarifas_de_venta": "selling_fees",
    "tarifas_de_logística_de_amazon": "fba_fees",
    "tarifas_de_otras_transacciones": "other_transaction_fees",
    "otro": "other",
    "total": "total",
}

# Normalized French header -> canonical column (apostrophes and case as given).
HEADERS_FR = {
    "date_heure": "date_time",
    "numéro_de_versement": "settlement_id",
    "type": "type",
    "numéro_de_la_commande": "order_id",
    "sku": "sku",
    "description": "description",
    "quantité": "quantity",
    "Marketplace": "marketplace",
    "traitement": "fulfillment",
    "ville_d'où_provient_la_commande": "order_city",
    "Région_d'où_provient_la_commande": "order_state",
    "code_postal_de_la_commande": "order_postal",
    "Modèle_de_perception_des_taxes": "tax_collection_model",
    "ventes_de_produits": "product_sales",
    "Taxes_sur_la_vente_des_produits": "product_sales_tax",
    "crédits_d'expédition": "shipping_credits",
    "taxe_sur_les_crédits_d’expédition": "shipping_credits_tax",
    "crédits_sur_l'emballage_cadeau": "gift_wrap_credits",
    "Taxes_sur_les_crédits_cadeaux": "giftwrap_credits_tax",
    "Rabais_promotionnels": "promotional_rebates",
    "Taxes_sur_les_remises_promotionnelles": "promotional_rebates_tax",
    "Taxes_retenues_sur_le_site_de_vente": "marketplace_withheld_tax",
    "frais_de_vente": "selling_fees",
    "Frais_Expédié_par_Amazon": "fba_fees",
    "autres_frais_de_transaction": "other_transaction_fees",
    "autre": "other",
    "total": "total",
}

# Localized month abbreviation -> English, in calendar order.
MONTHS_IT = {
    "gen": "Jan", "feb": "Feb", "mar": "Mar", "apr": "Apr", "mag": "May", "giu": "Jun",
    "lug": "Jul", "ago": "Aug", "set": "Sep", "ott": "Oct", "nov": "Nov", "dic": "Dec",
}
MONTHS_ES = {
    "ene": "Jan", "feb": "Feb", "mar": "Mar", "abr": "Apr", "may": "May", "jun": "Jun",
    "jul": "Jul", "ago": "Aug", "sep": "Sep", "oct": "Oct", "nov": "Nov", "dic": "Dec",
}
MONTHS_FR = {
    "janv.": "Jan", "févr.": "Feb", "mars": "Mar", "avr.": "Apr", "mai": "May", "juin": "Jun",
    "juil.": "Jul", "août": "Aug", "sept.": "Sep", "oct.": "Oct", "nov.": "Nov", "déc.": "Dec",
}

# Report file name forms.
UNIFIED_FILE_PATTERN = r"(\d{4}[A-Za-z]{3}\d{1,2})-(\d{4}[A-Za-z]{3}\d{1,2})CustomUnifiedTransaction\.csv"
PLAIN_FILE_PATTERN = r"(\d{4}[A-Za-z]{3}\d{1,2})-(\d{4}[A-Za-z]{3}\d{1,2})CustomTransaction\.csv"
LANDED_FILE_PATTERN = r"([a-z]+)_sales_(\d{4}-\d{2}-\d{2})\.csv"
NAME_DATE_FORMAT = "yyyyMMMd"

# Summary group label: markets whose name contains it are shown and totalled
# as one group (a parameter; the label of the group row is built from it).
DEFAULT_GROUP = "EU"

# --------------------------------------------------------------------------
# Our own choices (not from the reports): parse patterns, tried in order.
# --------------------------------------------------------------------------

US_DATETIME_PATTERNS = [
    "MMM d, yyyy h:mm:ss a",
    "MMM d, yyyy H:mm:ss",
    "MMM d, yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm:ss a",
    "M/d/yyyy",
]

# Per market the native form comes first: a failed pattern costs a parse
# attempt per row, so the list is short and ordered by what the reports write.
DE_DATETIME_PATTERNS = [
    "d.M.yyyy H:mm:ss",
    "d.M.yyyy H:mm",
    "d.M.yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
]

MONTH_NAME_DATETIME_PATTERNS = [
    "d MMM yyyy H:mm:ss",
    "d MMM yyyy H:mm",
    "d MMM yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
]

# Any day-first form (for text of unknown origin).
DAYFIRST_DATETIME_PATTERNS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "d.M.yyyy H:mm:ss",
    "d.M.yyyy H:mm",
    "d.M.yyyy",
    "d MMM yyyy H:mm:ss",
    "d MMM yyyy H:mm",
    "d MMM yyyy",
    "d/M/yyyy H:mm:ss",
    "d/M/yyyy H:mm",
    "d/M/yyyy",
    "d-M-yyyy H:mm:ss",
    "d-M-yyyy",
]


@dataclass(frozen=True)
class LocaleProfile:
    """How one market writes its settlement report."""

    name: str
    headers: dict = field(default_factory=dict)     # normalized header -> canonical
    months: dict = field(default_factory=dict)      # localized month -> English
    lower_headers: bool = False
    strip_colon: bool = False
    zones: tuple = ()                               # literal suffixes removed before parsing
    datetime_patterns: tuple = ()
    decimal_comma: bool = False
    numeric_columns: tuple = ()
    columns: tuple = ()                             # canonical projection, in order
    normalize_spaces: bool = False


def _canonical_without(*missing: str) -> tuple:
    return tuple(c for c in CANONICAL_COLUMNS if c not in missing)


PROFILES = {
    "us": LocaleProfile(
        name="us", zones=(" PST", " PDT"), datetime_patterns=tuple(US_DATETIME_PATTERNS),
        numeric_columns=tuple(NUMERIC_COLUMNS_US), columns=tuple(CANONICAL_COLUMNS)),
    # Second US brand: same report, no ASIN enrichment.
    "us2": LocaleProfile(
        name="us2", zones=(" PST", " PDT"), datetime_patterns=tuple(US_DATETIME_PATTERNS),
        numeric_columns=tuple(NUMERIC_COLUMNS_US), columns=_canonical_without("ASIN")),
    "de": LocaleProfile(
        name="de", headers=HEADERS_DE, zones=(" UTC",),
        datetime_patterns=tuple(DE_DATETIME_PATTERNS), decimal_comma=True,
        numeric_columns=tuple(NUMERIC_COLUMNS_EU),
        columns=_canonical_without("ASIN", "account_type", "Regulatory_Fee", "Tax_On_Regulatory_Fee")),
    "it": LocaleProfile(
        name="it", headers=HEADERS_IT, months=MONTHS_IT, lower_headers=True, strip_colon=True,
        zones=(" UTC",), datetime_patterns=tuple(MONTH_NAME_DATETIME_PATTERNS), decimal_comma=True,
        numeric_columns=tuple(NUMERIC_COLUMNS_EU), normalize_spaces=True,
        columns=_canonical_without("ASIN", "account_type", "Regulatory_Fee", "Tax_On_Regulatory_Fee")),
    "es": LocaleProfile(
        name="es", headers=HEADERS_ES, months=MONTHS_ES, lower_headers=True,
        zones=(" UTC",), datetime_patterns=tuple(MONTH_NAME_DATETIME_PATTERNS), decimal_comma=True,
        numeric_columns=tuple(NUMERIC_COLUMNS_EU), normalize_spaces=True,
        columns=_canonical_without("ASIN", "account_type", "Regulatory_Fee", "Tax_On_Regulatory_Fee")),
    "fr": LocaleProfile(
        name="fr", headers=HEADERS_FR, months=MONTHS_FR,
        zones=(" UTC",), datetime_patterns=tuple(MONTH_NAME_DATETIME_PATTERNS), decimal_comma=True,
        numeric_columns=tuple(NUMERIC_COLUMNS_EU), normalize_spaces=True,
        columns=_canonical_without("ASIN", "account_type", "Regulatory_Fee", "Tax_On_Regulatory_Fee")),
}


def profile(name: str) -> LocaleProfile:
    return PROFILES[name]
