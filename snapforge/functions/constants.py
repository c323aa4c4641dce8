"""Fixed values that results must equal: code tables and column names."""

#: Scope code to facility group.
FACILITY_GROUP_OF = {
    "BG": "Non-liquid biofuels assets",
    "BM": "Non-liquid biofuels assets",
    "LNGT": "Non-liquid biofuels assets",
    "LP": "Non-liquid biofuels assets",
    "BP": "LCF Trading liquid biofuels assets",
    "CPP": "LCF Trading liquid biofuels assets",
    "EP": "LCF Trading liquid biofuels assets",
    "ET": "LCF Trading liquid biofuels assets",
    "MT": "LCF Trading liquid biofuels assets",
    "HEFA": "LCF Trading liquid biofuels assets",
    "HVO": "LCF Trading liquid biofuels assets",
    "COF": "Feedstock for Biofuels Companies",
    "COP": "Feedstock for Biofuels Companies",
    "CP": "Feedstock for Biofuels Companies",
    "FA": "Feedstock for Biofuels Companies",
    "FG": "Feedstock for Biofuels Companies",
    "FP": "Feedstock for Biofuels Companies",
    "ISHC": "Feedstock for Biofuels Companies",
    "MP": "Feedstock for Biofuels Companies",
    "OM": "Feedstock for Biofuels Companies",
    "OT": "Feedstock for Biofuels Companies",
    "PM": "Feedstock for Biofuels Companies",
    "PO": "Feedstock for Biofuels Companies",
    "PU": "Feedstock for Biofuels Companies",
    "PYP": "Feedstock for Biofuels Companies",
    "SM": "Feedstock for Biofuels Companies",
    "TW": "Feedstock for Biofuels Companies",
    "COMP": "Other Processing Plants/Units",
    "CV": "Other Processing Plants/Units",
    "ML": "Other Processing Plants/Units",
    "MRP": "Other Processing Plants/Units",
    "PP": "Other Processing Plants/Units",
    "RE": "Other Processing Plants/Units",
    "SC": "Other Processing Plants/Units",
    "CR": "Other Processing Plants/Units",
    "FPR": "Other Processing Plants/Units",
    "FSA": "Other Processing Plants/Units",
    "WH": "Other Processing Plants/Units",
    "LC": "Transport & Logistics Companies",
    "TC": "Transport & Logistics Companies",
    "IPEL": "Electricity Assets",
    "IPES": "Electricity Assets",
    "IPER": "Electricity Assets",
    "IPEM": "Electricity Assets",
    "PWP": "Chemicals Assets",
    "SCP": "Chemicals Assets",
    "PoC-TR": "Trading Companies",
    "TR": "Trading Companies",
    "TRS": "Trading Companies",
}

#: Certificate prefix to certificate type; each type stands once, so classes are found the other way round.
CERTIFICATE_TYPES = {
    "EU ISCC": "Mandated",
    "ISCC PLUS": "Voluntary",
    "ISCC JAPAN": "Japan FIT",
    "ISCC CORSIA": "Aviation",
    "ISCC CFC": "Carbon Footprint Certification",
    "DE B BLE BM": "Legacy",
}
#: Prefixes that stand for a type beside the table above.
TYPE_ALIASES = {"CORSIA ISCC": "Aviation", "DE B": "Legacy"}

#: Country names as they come out of the owner column, to the names wanted.
COUNTRY_OVERRIDES = {
    "Republic of": "South Korea",
    "Province of China": "Taiwan",
    "Bolivarian Republic of": "Venezuela",
    "Ireland": "Republic of Ireland",
    "Viet Nam": "Vietnam",
    "Macedonia": "North Macedonia",
    "Russian Federation": "Russia",
    "Côte d'Ivoire": "Ivory Coast",
    "The Netherlands": "Netherlands",
    "British": "British Virgin Islands",
    "Islamic Republic of": "Iran",
    "Lettland": "Latvia",
    "Libyan Arab Jamahiriya": "Libya",
    "Reunion": "Réunion",
    "Swaziland": "Eswatini",
    "United Republic of": "Tanzania",
    "Slowakei": "Slovakia",
    "Hong Kong": "China",
}
COUNTRY_SMALL_WORDS = ("of", "the", "and")

STATUSES = {1: "Valid", 5: "Expired", 10: "Expired", 12: "Terminated", 13: "Withdrawn", 15: "Suspended", 20: "Expired", 21: "Expired"}

SCOPE_DESCRIPTIONS = {
    "BFO": "Biomarine fuel operator",
    "BG": "Biogas plant",
    "BM": "Biomethane plant",
    "BP": "Biodiesel plant",
    "COF": "Central Office (Group of farms/plantations)",
    "COMP": "Compounding plant",
    "COP": "Central Office (Group of Points of Origin)",
    "CP": "Collecting Point (for waste/residue material not grown/harvested on farms/plantations)",
    "CPP": "Co-Processing plant",
    "CR": "Crushing plant",
    "CV": "Converter",
    "EL": "Electrolyser",
    "EP": "Ethanol plant",
    "ET": "ETBE plant",
    "FA": "Farm / Plantation",
    "FG": "First Gathering Point (for biomass grown/harvested on farms/plantations)",
    "FP": "Food processing plant",
    "FPR": "Final Product Refinement",
    "FSA": "Forest sourcing area",
    "HEFA": "HEFA plant",
    "HVO": "HVO plant",
    "ISHC": "Central Office for Independent Smallholders",
    "IPEL": "Installation producing energy (electricity, heating or cooling) from bioliquids",
    "IPES": "Installation producing energy (electricity, heating or cooling) from solid biomass",
    "IPER": "Installation producing energy (electricity, heating or cooling) from raw biogas",
    "IPEM": "Installation producing energy (electricity, heating or cooling) from biomethane",
    "LC": "Logistic Center",
    "LNGT": "LNG terminal",
    "LP": "Liquefaction Plant",
    "ML": "Methanol plant",
    "MP": "Melting plant",
    "MRP": "Mechanical Recycling Plant",
    "MT": "MTBE plant",
    "OM": "Oil mill",
    "OT": "Other conversion unit",
    "PM": "Pulp mill",
    "PO": "Point of Origin",
    "PoC-TR": "Proof of Compliance Trader",
    "PP": "Polymerization plant",
    "PU": "Processing Unit",
    "PWP": "Plastic Waste Processor",
    "PYP": "Pyrolysis plant",
    "RE": "Refinery",
    "SC": "Cracker",
    "SCP": "Speciality Chemical Plant",
    "SM": "Sugar mill",
    "TC": "Transport Company",
    "TR": "Trader",
    "TRS": "Trader with storage",
    "TW": "Treatment plant for waste/ residues",
    "WH": "Warehouse",
    "WR36": "acc. to 36th BImSchV (double counting of biofuels in Germany)",
}

#: The raw cells of a certificate, in their order.
RAW_COLUMNS = (
    "cert_ikon cert_number cert_owner cert_scope cert_processingunittype cert_in_put cert_add_on cert_products "
    "cert_valid_from cert_valid_until cert_suspended_date cert_issuer cert_map cert_file cert_audit cert_status"
).split()

#: The snapshot's columns in order, with the raw column behind those that are only renamed.
SNAPSHOT_COLUMNS = {
    "Status": None, "Certificate_ID": "cert_number", "Certificate_Type": None, "Certificate_Class": None, "Certificate_Holder": "cert_owner",
    "Company_Name": None, "City": None, "Country": None, "Region": None, "Sub_Region": None, "Scope": "cert_scope", "Scope_Description": None,
    "Facility_Grouping": None, "Processing_Unit_Type": "cert_processingunittype", "Processing_Unit_Type_Description": None, "Raw_Material": "cert_in_put",
    "Add-ons** /CTS": "cert_add_on", "Products": "cert_products", "Valid_From": "cert_valid_from", "Valid_Until": "cert_valid_until", "Suspended": "cert_suspended_date",
    "Issuing_CB": "cert_issuer", "Map": "cert_map", "Latitude": None, "Longitude": None, "Certificate": "cert_file", "Audit_Report": "cert_audit", "Status_Code": "cert_status",
    "Asset_Identifier": None, "Match_Found": None,
}

#: Literals that the company key drops, in the order in which they are replaced.
COMPANY_REMOVALS = [" inc", " llc", " l.l.c", " lp", " l.p.", " bv", " b.v.", " ltd", " co", " company", " limited", ".", ",", "&", "ltd.", "pte.", "gmbh", "ag", "plc", "s.p.a"]
#: Characters that a comparison ignores.
INVISIBLE = "\u200b\u200c\u200d\ufeff\u00a0\u2060\u202f\u00ad"
LOCATION_SUFFIXES = [r",\s*Budapest,\s*Hungary\s*$"]
#: Score from which a company name is replaced, and an asset counts as found.
COMPANY_SCORE, ASSET_SCORE = 51, 80

#: Master-data columns; the regions' are the defaults of a parameter, as geographies name them differently.
GEO_COUNTRY, GEO_REGION, GEO_SUB_REGION = "Country", "Region", "Sub Region"
ASSET_COMPANY, ASSET_SHORT, ASSET_CITY, ASSET_ID = "Company/Producer", "Company/Producer Short Name", "City", "Asset Identifier"

#: Presentation: status to style, and the columns of either provenance.
MATCH_STYLE = "green"
STATUS_STYLES = {"Valid": "green", "Expired": "orange", "Suspended": "red", "Terminated": "red", "Withdrawn": "red"}
SOURCE_DERIVED = "City Country Company_Name Certificate_Class Scope_Description Processing_Unit_Type_Description Latitude Longitude Value_Changed".split()
BUSINESS_DERIVED = "Certificate_Type Facility_Grouping Region Sub_Region Asset_Identifier Match_Found".split()
