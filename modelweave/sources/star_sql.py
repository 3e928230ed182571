"""The raw model graph of a star schema, as SQL.

Row = element, table = metaclass, column = attribute, foreign key = association. Besides the
business metamodel, every part brand is a metamodel of its own (brand, type, name and part
classes), every supplier is a library (its offer is an enumeration) and every document source is a
profile, so all tables grow with the data. A ``{name}`` refers to a star table or to another entry.
The few names that must not resolve (missing documents, unknown metaclasses, dangling references)
are there for the error tables.
"""

from __future__ import annotations

_BUSINESS_CLASSES = """(VALUES
  ('Element', true), ('NamedElement', true), ('Place', true), ('Party', true),
  ('Region', false), ('Nation', false), ('Customer', false), ('Supplier', false), ('Part', false),
  ('Order', false), ('LineItem', false), ('Document', false), ('Page', false),
  ('Conversation', false), ('Turn', false), ('Vector', false), ('User', false)
) AS t(name, is_abstract)"""

_BUSINESS_PARENTS = """(VALUES
  ('NamedElement', 'Element'), ('Place', 'NamedElement'), ('Party', 'NamedElement'),
  ('Region', 'Place'), ('Nation', 'Place'), ('Customer', 'Party'), ('Supplier', 'Party'),
  ('Customer', 'Element'), ('Part', 'NamedElement'), ('Order', 'Element'), ('LineItem', 'Element'),
  ('Document', 'Element'), ('Page', 'Element'), ('Conversation', 'Element'), ('Turn', 'Element'),
  ('Vector', 'Element'), ('User', 'Element')
) AS t(specific, general)"""

_BUSINESS_ATTRIBUTES = """(VALUES
  ('NamedElement', 0, 'name', 'dt:String', 1, false, false),
  ('Party', 0, 'acctbal', 'dt:Real', 1, false, false),
  ('Customer', 0, 'mktsegment', 'en:MarketSegment', 1, false, false),
  ('Customer', 1, 'wallet', 'ds:Money', 1, false, false),
  ('Part', 0, 'brand', 'dt:String', 1, false, false),
  ('Part', 1, 'ptype', 'dt:String', 1, false, false),
  ('Part', 2, 'size', 'dt:Integer', 1, false, false),
  ('Part', 3, 'retailprice', 'dt:Real', 1, false, false),
  ('Order', 0, 'orderyear', 'dt:Integer', 1, false, true),
  ('Order', 1, 'orderstatus', 'en:OrderStatus', 1, false, false),
  ('Order', 2, 'totalprice', 'dt:Real', 1, false, false),
  ('Order', 3, 'orderpriority', 'en:Priority', 1, false, false),
  ('Order', 4, 'total', 'ds:Money', 1, false, false),
  ('LineItem', 0, 'quantity', 'dt:Real', 1, false, false),
  ('LineItem', 1, 'extendedprice', 'dt:Real', 1, false, false),
  ('LineItem', 2, 'discount', 'dt:Real', 1, false, false),
  ('LineItem', 3, 'tax', 'dt:Real', 1, false, false),
  ('LineItem', 4, 'returnflag', 'en:ReturnFlag', 1, false, false),
  ('LineItem', 5, 'linestatus', 'en:LineStatus', 1, false, false),
  ('LineItem', 6, 'charges', 'ds:Money', -1, true, false),
  ('LineItem', 7, 'shipdate', 'dt:String', 1, false, false),
  ('Document', 0, 'nchars', 'dt:Integer', 1, false, false),
  ('Document', 1, 'lang', 'en:Lang', 1, false, false),
  ('Document', 2, 'lines', 'dt:String', -1, false, false),
  ('Page', 0, 'html', 'dt:String', 1, false, false),
  ('Turn', 0, 'role', 'en:Role', 1, false, false),
  ('Turn', 1, 'text', 'dt:String', 1, false, false),
  ('Vector', 0, 'embedding', 'dt:Real', -1, true, false),
  ('Vector', 1, 'label', 'dt:Integer', 1, false, false),
  ('User', 0, 'scores', 'dt:Real', -1, true, false),
  ('User', 1, 'amount', 'dt:Real', 1, false, false),
  ('User', 2, 'steps', 'en:Step', -1, true, false),
  ('User', 3, 'status', 'en:Step', 1, false, false)
) AS t(owner, position, name, type, upper, is_ordered, is_derived)"""

# Association ends as the model is meant; `flipped` associations declare their ends the other way round.
_BUSINESS_ENDS = """(VALUES
  ('A_place_place', 'container', 'Place', 'contained', 'Place', true, false, -1, false),
  ('A_region_nation', 'region', 'Region', 'nations', 'Nation', true, false, -1, false),
  ('A_nation_place', 'nation_c', 'Nation', 'contained__from_Nation', 'Place', true, false, -1, false),
  ('A_nation_party', 'nation', 'Nation', 'parties', 'Party', false, false, -1, false),
  ('A_nation_customer', 'nation_k', 'Nation', 'customers', 'Customer', false, false, -1, false),
  ('A_nation_supplier', 'nation_s', 'Nation', 'suppliers', 'Supplier', false, false, -1, false),
  ('A_customer_order', 'customer', 'Customer', 'orders', 'Order', false, false, -1, false),
  ('A_customer_home', 'residents_of', 'Customer', 'home', 'Nation', false, false, 1, false),
  ('A_order_lineitem', 'order', 'Order', 'items', 'LineItem', true, true, -1, false),
  ('A_part_lineitem', 'part', 'Part', 'uses', 'LineItem', false, false, -1, false),
  ('A_conversation_turn', 'conversation', 'Conversation', 'turns', 'Turn', true, true, -1, false),
  ('A_user_cart', 'buyer', 'User', 'cart', 'Part', false, true, -1, false),
  ('A_nation_user', 'owner', 'Nation', 'residents', 'User', false, false, -1, false),
  ('A_document_page', '_document', 'Document', 'pages', 'Page', false, false, -1, true)
) AS t(name, s_name, s_class, t_name, t_class, composite, ordered, t_upper, flipped)"""

_BUSINESS_RELS = """(VALUES
  ('ae:A_region_nation.s', 'redefines', 'ae:A_place_place.s'),
  ('ae:A_region_nation.t', 'subsets', 'ae:A_place_place.t'),
  ('ae:A_nation_place.s', 'redefines', 'ae:A_place_place.s'),
  ('ae:A_nation_place.t', 'redefines', 'ae:A_place_place.t'),
  ('ae:A_nation_customer.s', 'subsets', 'ae:A_nation_party.s'),
  ('ae:A_nation_customer.t', 'subsets', 'ae:A_nation_party.t'),
  ('ae:A_nation_supplier.s', 'subsets', 'ae:A_nation_party.s'),
  ('ae:A_nation_supplier.t', 'redefines', 'ae:A_nation_party.t')
) AS t(feature, rel, target)"""

# stereotype, position, name, type, upper, ordered, derived, composite, extension end
_PROFILE_PROPERTIES = (
    ("Scored", 0, "note", "'dt:String'", 1, False, False, False, False),
    ("Quality", 0, "base_Document", "'mc:Document'", 1, False, False, False, True),
    ("Quality", 1, "flag", "'dt:Boolean'", 1, False, False, False, False),
    ("Quality", 2, "evidence", "'mc:Document'", -1, True, False, False, False),
    ("Quality", 3, "rank", "'dt:Integer'", -1, True, False, False, False),
    ("Quality", 4, "langs", "'en:Lang'", -1, True, False, False, False),
    ("Quality", 5, "price", "'ds:Money'", -1, True, False, False, False),
    ("Quality", 6, "computed", "'mc:Document'", 1, False, True, False, False),
    ("Toxic", 0, "base_Document", "'mc:Document'", 1, False, False, False, True),
    ("Toxic", 1, "related", "'mc:Document'", -1, False, False, True, False),
    ("Toxic", 2, "contrast", "'st:' || source || ':Quality'", 1, False, False, False, False),
    ("Toxic", 3, "legacy", "'mc:Legacy'", 1, False, False, False, False),
)


def _profile_property(row: tuple) -> str:
    owner, position, name, type_, upper, *flags = row
    ordered, derived, composite, extension = (str(f).lower() for f in flags)
    return (
        f"SELECT 'urn:profile:' || source, 'pp:' || source || ':{owner}.{name}', 'st:' || source || ':{owner}',"
        f" {position}, '{name}', {type_}, 0, {upper}, {ordered}, {derived}, {composite},"
        f" false, false, true, CAST(NULL AS STRING), {extension} FROM {{source}}"
    )


_PROFILE_FEATURES = "\nUNION ALL ".join(_profile_property(row) for row in _PROFILE_PROPERTIES)

# Relation of a type-level end (by part type) and of a part-level end (by size) to the end above it.
_TYPE_SOURCE = """CASE WHEN p_type IN ('STANDARD', 'ECONOMY', 'PROMO') THEN 'subsets'
  WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'redefines' END"""
_TYPE_TARGET = """CASE WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'subsets'
  WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'redefines' END"""
_PART_SOURCE = "CASE WHEN p_size <= 20 THEN 'subsets' WHEN p_size <= 40 THEN 'redefines' END"
_PART_TARGET = """CASE WHEN p_size <= 10 OR p_size BETWEEN 21 AND 30 THEN 'subsets'
  WHEN p_size <= 40 THEN 'redefines' END"""

# Elements by their kind, which is the branch of the union they come from.
ELEMENT_ROWS = {
    "Region": """SELECT 'urn:tpch' AS resource, 'reg:' || CAST(r_regionkey AS STRING) AS uuid, 'Region' AS kind, r_name AS name,
  CAST(NULL AS STRING) AS owner, false AS is_abstract, CAST(NULL AS STRING) AS url FROM {region}""",
    "Nation": """SELECT 'urn:tpch', 'nat:' || CAST(n_nationkey AS STRING), 'Nation', n_name,
  'reg:' || CAST(n_regionkey AS STRING), false, NULL FROM {nation}""",
    "Customer": """SELECT 'urn:tpch', 'cus:' || CAST(c_custkey AS STRING), 'Customer', c_name,
  'nat:' || CAST(c_nationkey AS STRING), false, NULL FROM {customer}""",
    "Supplier": """SELECT 'urn:tpch', 'sup:' || CAST(s_suppkey AS STRING), 'Supplier', s_name,
  'nat:' || CAST(s_nationkey AS STRING), false, NULL FROM {supplier}""",
    "Part": """SELECT 'urn:tpch', 'par:' || CAST(p_partkey AS STRING), 'Part', p_name, NULL, false, NULL FROM {part}""",
    "Order": """SELECT 'urn:tpch', 'ord:' || CAST(o_orderkey AS STRING), 'Order', NULL,
  'cus:' || CAST(o_custkey AS STRING), false, NULL FROM {orders}""",
    "LineItem": """SELECT 'urn:tpch', 'lin:' || CAST(l_orderkey AS STRING) || '.' || CAST(idx AS STRING), 'LineItem', NULL,
  'ord:' || CAST(l_orderkey AS STRING), false, NULL FROM {lineitem_at}""",
    "Document": """SELECT 'urn:text:' || source, 'doc:' || CAST(doc_id AS STRING), 'Document', NULL, NULL, false, NULL
FROM {documents}""",
    "Page": """SELECT 'urn:web', 'pag:' || CAST(page_id AS STRING), 'Page', NULL, NULL, false, url FROM {pages}""",
    "Conversation": """SELECT DISTINCT 'urn:dialog', 'con:' || CAST(conv_id AS STRING), 'Conversation', CAST(NULL AS STRING),
  CAST(NULL AS STRING), false, CAST(NULL AS STRING) FROM {conversations}""",
    "Turn": """SELECT 'urn:dialog', 'tur:' || CAST(conv_id AS STRING) || '.' || CAST(turn AS STRING), 'Turn', NULL,
  'con:' || CAST(conv_id AS STRING), false, NULL FROM {conversations}""",
    "Vector": """SELECT 'urn:vectors', 'vec:' || CAST(vec_id AS STRING), 'Vector', NULL, NULL, false, NULL FROM {embeddings}""",
    "User": """SELECT DISTINCT 'urn:events', 'usr:' || CAST(user_id AS STRING), 'User', CAST(NULL AS STRING),
  CAST(NULL AS STRING), false, CAST(NULL AS STRING) FROM {events}""",
    "Benchmark": """SELECT 'urn:bench', 'ben:' || CAST(item_id AS STRING), 'Benchmark', NULL, NULL, false, NULL FROM {benchmark}""",
    "Class": """SELECT resource, uuid, 'Class', name, 'pkg:' || substring(resource, 5), is_abstract, NULL FROM {raw_class}""",
    "Association": """SELECT resource, uuid, 'Association', name, 'pkg:' || substring(resource, 5), is_abstract, NULL
FROM {raw_association}""",
    "Stereotype": """SELECT resource, uuid, 'Stereotype', name, profile, is_abstract, NULL FROM {raw_stereotype}""",
    "Package": """SELECT resource, scope_package, 'Package', scope_package, NULL, false, NULL FROM {raw_document}
WHERE kind <> 'Profile'""",
    "Profile": """SELECT 'urn:profile:' || source, 'pf:' || source, 'Profile', source, NULL, false, NULL FROM {source}""",
}

# What a union of some of them starts with, so that its columns have names and types.
NO_ELEMENT = """SELECT CAST(NULL AS STRING) AS resource, CAST(NULL AS STRING) AS uuid, CAST(NULL AS STRING) AS kind,
  CAST(NULL AS STRING) AS name, CAST(NULL AS STRING) AS owner, false AS is_abstract, CAST(NULL AS STRING) AS url
WHERE false"""

# The number in the JSON column `props`; engines spell it differently.
JSON_K = "<k of props>"

STAR = {
    # ------------------------------------------------------------ helpers
    "brand": "SELECT DISTINCT p_brand FROM {part}",
    "brand_type": "SELECT DISTINCT p_brand, p_type FROM {part}",
    "brand_name": "SELECT DISTINCT p_brand, p_name FROM {part}",
    "source": "SELECT DISTINCT source FROM {documents}",
    "source_lang": "SELECT DISTINCT source, lang FROM {documents}",
    "supplied": "SELECT DISTINCT l_suppkey, l_partkey FROM {lineitem}",
    "offer": """SELECT DISTINCT l_suppkey, p_brand FROM {supplied} JOIN {part} ON l_partkey = p_partkey""",
    "labelled": """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    # ------------------------------------------------------------ documents, selection
    "raw_document": """
SELECT resource, scope_package, kind, resource AS package_uri, resource || '.json' AS document_url,
  kind || 'Artifact' AS artifact_kind, 'ns' AS ns_prefix, scope_package AS uuid_prefix,
  'T_' || scope_package AS tool_package_id, 'tool://' || scope_package AS tool_package_url
FROM (
  SELECT resource, scope_package, kind FROM (VALUES
    ('urn:lib:types', 'pkg:types', 'Library'), ('urn:mm:business', 'pkg:mm:business', 'Metamodel'),
    ('urn:tpch', 'pkg:tpch', 'Model'), ('urn:web', 'pkg:web', 'Model'), ('urn:dialog', 'pkg:dialog', 'Model'),
    ('urn:vectors', 'pkg:vectors', 'Model'), ('urn:events', 'pkg:events', 'Model'),
    ('urn:bench', 'pkg:bench', 'Model')) AS t(resource, scope_package, kind)
  UNION ALL SELECT 'urn:lib:sup:' || CAST(s_suppkey AS STRING), 'pkg:sup:' || CAST(s_suppkey AS STRING), 'Library'
  FROM {supplier}
  UNION ALL SELECT 'urn:mm:' || p_brand, 'pkg:mm:' || p_brand, 'Metamodel' FROM {brand}
  UNION ALL SELECT 'urn:profile:' || source, 'pf:' || source, 'Profile' FROM {source} WHERE source <> 'src19'
  UNION ALL SELECT 'urn:text:' || source, 'pkg:text:' || source, 'Model' FROM {source}
) AS d""",
    # What the user chose to export: src18's profile and two models are left out, src19's profile has no document.
    "raw_selection": """
SELECT scope_package FROM {raw_document} WHERE scope_package NOT IN ('pf:src18', 'pkg:events', 'pkg:text:src17')
UNION ALL SELECT 'pf:' || source FROM {source} WHERE source = 'src19'""",
    "raw_configuration": """
SELECT tool_package_id FROM {raw_document}
UNION ALL SELECT 'T_gone:' || p_brand FROM {brand}
UNION ALL SELECT 'T_mc:par:' || CAST(p_partkey AS STRING) FROM {part}""",
    # ------------------------------------------------------------ classes, stereotypes, types
    "raw_class": f"""
SELECT 'urn:mm:business' AS resource, 'mc:' || name AS uuid, name, is_abstract FROM {_BUSINESS_CLASSES}
UNION ALL SELECT 'urn:mm:' || p_brand, 'mc:' || p_brand || '.Item', 'Item@' || p_brand, true FROM {{brand}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'mc:' || p_brand || '.' || p_type, p_type || '@' || p_brand, true
FROM {{brand_type}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'mc:' || p_brand || '.' || p_name, p_name || '@' || p_brand, true
FROM {{brand_name}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'mc:par:' || CAST(p_partkey AS STRING),
  'Part_' || CAST(p_partkey AS STRING), false FROM {{part}}""",
    "raw_stereotype": """
SELECT 'urn:profile:' || source AS resource, 'st:' || source || ':Scored' AS uuid, 'Scored' AS name,
  true AS is_abstract, 'pf:' || source AS profile FROM {source}
UNION ALL SELECT 'urn:profile:' || source, 'st:' || source || ':Quality', 'Quality', false, 'pf:' || source
FROM {source}
UNION ALL SELECT 'urn:profile:' || source, 'st:' || source || ':Toxic', 'Toxic', false, 'pf:' || source
FROM {source}
UNION ALL SELECT 'urn:profile:' || source, 'st:' || source || ':' || lang, 'Lang_' || lang, false, 'pf:' || source
FROM {source_lang}""",
    "raw_generalization": f"""
SELECT 'mc:' || specific AS specific, 'mc:' || general AS general FROM {_BUSINESS_PARENTS}
UNION ALL SELECT 'mc:' || p_brand || '.Item', 'mc:Part' FROM {{brand}}
UNION ALL SELECT 'mc:' || p_brand || '.' || p_type, 'mc:' || p_brand || '.Item' FROM {{brand_type}}
UNION ALL SELECT 'mc:' || p_brand || '.' || p_name, 'mc:' || p_brand || '.Item' FROM {{brand_name}}
UNION ALL SELECT 'mc:par:' || CAST(p_partkey AS STRING), 'mc:' || p_brand || '.' || p_type FROM {{part}}
UNION ALL SELECT 'mc:par:' || CAST(p_partkey AS STRING), 'mc:' || p_brand || '.' || p_name FROM {{part}}
UNION ALL SELECT uuid, profile_scored FROM (
  SELECT uuid, is_abstract, 'st:' || substring(profile, 4) || ':Scored' AS profile_scored FROM {{raw_stereotype}}
) AS s WHERE NOT is_abstract""",
    "raw_datatype": """
SELECT resource, uuid, name, type_kind FROM (VALUES
  ('urn:lib:types', 'dt:Boolean', 'Boolean', 'primitive'), ('urn:lib:types', 'dt:Integer', 'Integer', 'primitive'),
  ('urn:lib:types', 'dt:Real', 'Real', 'primitive'), ('urn:lib:types', 'dt:String', 'String', 'primitive'),
  ('urn:lib:types', 'dt:UnlimitedNatural', 'UnlimitedNatural', 'primitive'),
  ('urn:lib:types', 'en:MarketSegment', 'MarketSegment', 'enumeration'),
  ('urn:lib:types', 'en:OrderStatus', 'OrderStatus', 'enumeration'),
  ('urn:lib:types', 'en:Priority', 'Priority', 'enumeration'),
  ('urn:lib:types', 'en:ReturnFlag', 'ReturnFlag', 'enumeration'),
  ('urn:lib:types', 'en:LineStatus', 'LineStatus', 'enumeration'),
  ('urn:lib:types', 'en:Role', 'Role', 'enumeration'), ('urn:lib:types', 'en:Lang', 'Lang', 'enumeration'),
  ('urn:lib:types', 'en:Step', 'Step', 'enumeration'), ('urn:lib:types', 'ds:Money', 'Money', 'structured')
) AS t(resource, uuid, name, type_kind)
UNION ALL SELECT 'urn:lib:sup:' || CAST(s_suppkey AS STRING), 'dt:sup:' || CAST(s_suppkey AS STRING) || '.Code',
  'Integer', 'primitive' FROM {supplier}
UNION ALL SELECT 'urn:lib:sup:' || CAST(s_suppkey AS STRING), 'dt:sup:' || CAST(s_suppkey AS STRING) || '.Balance',
  CASE WHEN s_acctbal < 500 THEN 'Decimal' ELSE 'Real' END, 'primitive' FROM {supplier}
UNION ALL SELECT 'urn:lib:sup:' || CAST(s_suppkey AS STRING), 'en:sup:' || CAST(s_suppkey AS STRING),
  'Offer_' || CAST(s_suppkey AS STRING), 'enumeration' FROM {supplier}
UNION ALL SELECT 'urn:lib:sup:' || CAST(s_suppkey AS STRING), 'ds:sup:' || CAST(s_suppkey AS STRING),
  'Price_' || CAST(s_suppkey AS STRING), 'structured' FROM {supplier}""",
    "raw_type": """
SELECT resource, uuid, name, type_kind FROM {raw_datatype}
UNION ALL SELECT resource, uuid, name, 'class' FROM {raw_class}
UNION ALL SELECT resource, uuid, name, 'stereotype' FROM {raw_stereotype}
UNION ALL SELECT * FROM (VALUES ('urn:other', 'mc:Legacy', 'Legacy', 'class')) AS t(resource, uuid, name, type_kind)""",
    "literal_value": """
SELECT 'urn:lib:types' AS resource, 'en:' || enumeration AS enumeration,
  'lit:' || enumeration || '.' || name AS uuid, name
FROM (
  SELECT DISTINCT 'MarketSegment' AS enumeration, c_mktsegment AS name FROM {customer}
  UNION ALL SELECT DISTINCT 'OrderStatus', o_orderstatus FROM {orders}
  UNION ALL SELECT DISTINCT 'Priority', o_orderpriority FROM {orders}
  UNION ALL SELECT DISTINCT 'ReturnFlag', l_returnflag FROM {lineitem}
  UNION ALL SELECT DISTINCT 'LineStatus', l_linestatus FROM {lineitem}
  UNION ALL SELECT DISTINCT 'Role', role FROM {conversations}
  UNION ALL SELECT DISTINCT 'Lang', lang FROM {documents}
  UNION ALL SELECT * FROM (VALUES ('Step', 's0'), ('Step', 's1'), ('Step', 's2')) AS t(enumeration, name)
) AS v
UNION ALL SELECT 'urn:lib:sup:' || CAST(l_suppkey AS STRING), 'en:sup:' || CAST(l_suppkey AS STRING),
  'lit:sup:' || CAST(l_suppkey AS STRING) || '.' || p_brand, p_brand FROM {offer}""",
    # ------------------------------------------------------------ associations and features
    "end_pair": f"""
SELECT 'urn:mm:business' AS resource, name, s_name, 'mc:' || s_class AS s_class, t_name,
  'mc:' || t_class AS t_class, composite, ordered, t_upper, flipped FROM {_BUSINESS_ENDS}
UNION ALL SELECT 'urn:mm:' || p_brand, 'A_' || p_brand, 'whole', 'mc:' || p_brand || '.Item', 'parts',
  'mc:' || p_brand || '.Item', true, false, -1, false FROM {{brand}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'A_' || p_brand || '.' || p_type, 'whole_' || p_type,
  'mc:' || p_brand || '.Item', CASE p_type WHEN 'LARGE' THEN 'parts__from_LARGE' WHEN 'SMALL' THEN 'parts' ELSE 'parts_' || p_type END,
  'mc:' || p_brand || '.' || p_type, true, p_type = 'SMALL', -1, false FROM {{brand_type}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'A_par_' || CAST(p_partkey AS STRING),
  CASE WHEN p_size > 45 THEN '_old' ELSE 'old' END, 'mc:par:' || CAST(p_partkey AS STRING), 'new',
  'mc:par:' || CAST(p_partkey AS STRING), p_size <= 25, p_type = 'SMALL', -1, p_size > 45 FROM {{part}}""",
    "raw_association": """
SELECT resource, 'as:' || name AS uuid, name, false AS is_abstract,
  'ae:' || name || CASE WHEN flipped THEN '.t' ELSE '.s' END AS end1,
  'ae:' || name || CASE WHEN flipped THEN '.s' ELSE '.t' END AS end2
FROM {end_pair}""",
    "raw_feature": f"""
SELECT 'urn:mm:business' AS resource, 'ft:' || owner || '.' || name AS uuid, 'mc:' || owner AS owner, position,
  name, type, 0 AS lower, upper, is_ordered, is_derived, false AS is_composite, false AS is_container,
  false AS is_containment, true AS is_changeable, CAST(NULL AS STRING) AS opposite, false AS is_extension_end
FROM {_BUSINESS_ATTRIBUTES}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:' || p_brand || '.Item.retired', 'mc:' || p_brand || '.Item', 0, 'retired',
  'dt:Boolean', 0, 1, false, true, false, false, false, true, NULL, false FROM {{brand}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:' || p_brand || '.Item.label', 'mc:' || p_brand || '.Item', 1, 'label',
  'dt:String', 0, 1, false, false, false, false, false, true, NULL, false FROM {{brand}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:' || p_brand || '.' || p_type || '.grade', 'mc:' || p_brand || '.' || p_type,
  0, 'grade', 'dt:Integer', 0, 1, false, false, false, false, false, true, NULL, false FROM {{brand_type}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:par:' || CAST(p_partkey AS STRING) || '.size',
  'mc:par:' || CAST(p_partkey AS STRING), 0, 'size', 'dt:Integer', 0, 1, false, p_size > 40, false, false, false,
  true, NULL, false FROM {{part}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:par:' || CAST(p_partkey AS STRING) || '.price',
  'mc:par:' || CAST(p_partkey AS STRING), 1, 'price', 'dt:Real', 1, 1, false, false, false, false, false,
  true, NULL, false FROM {{part}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:par:' || CAST(p_partkey AS STRING) || '.alias',
  'mc:par:' || CAST(p_partkey AS STRING), 2, 'alias', 'dt:String', 0, -1, true, false, false, false, false,
  true, NULL, false FROM {{part}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:par:' || CAST(p_partkey AS STRING) || '.segment',
  'mc:par:' || CAST(p_partkey AS STRING), 3, 'segment', 'en:MarketSegment', 0, 1, p_size <= 25, false, false, false,
  false, true, NULL, false FROM {{part}}
UNION ALL SELECT 'urn:mm:' || p_brand, 'ft:par:' || CAST(p_partkey AS STRING) || '.cost',
  'mc:par:' || CAST(p_partkey AS STRING), 4, 'cost', 'ds:Money', 0, 1, p_size > 25, false, false, false,
  false, true, NULL, false FROM {{part}}
UNION ALL SELECT resource, 'ae:' || name || '.t', s_class, 100, t_name, t_class, 0, t_upper, ordered, false, composite,
  false, composite, true, 'ae:' || name || '.s', false FROM {{end_pair}}
UNION ALL SELECT resource, 'ae:' || name || '.s', t_class, 101, s_name, s_class, 0, 1, false, false, false,
  composite, false, true, 'ae:' || name || '.t', false FROM {{end_pair}}
UNION ALL {_PROFILE_FEATURES}
UNION ALL SELECT 'urn:profile:' || source, 'pp:' || source || ':' || lang || '.base', 'st:' || source || ':' || lang, 0,
  'base', CASE lang WHEN 'fr' THEN NULL WHEN 'es' THEN 'mc:Legacy' ELSE 'mc:Document' END, 0, 1, false, false,
  false, false, false, true, NULL, true FROM {{source_lang}}""",
    "raw_feature_rel": f"""
SELECT feature, rel, target FROM {_BUSINESS_RELS}
UNION ALL SELECT 'ae:A_' || p_brand || '.' || p_type || '.s', {_TYPE_SOURCE}, 'ae:A_' || p_brand || '.s'
FROM {{brand_type}} WHERE {_TYPE_SOURCE} IS NOT NULL
UNION ALL SELECT 'ae:A_' || p_brand || '.' || p_type || '.t', {_TYPE_TARGET}, 'ae:A_' || p_brand || '.t'
FROM {{brand_type}} WHERE {_TYPE_TARGET} IS NOT NULL
UNION ALL SELECT 'ae:A_par_' || CAST(p_partkey AS STRING) || '.s', {_PART_SOURCE},
  'ae:A_' || p_brand || '.' || p_type || '.s' FROM {{part}} WHERE {_PART_SOURCE} IS NOT NULL
UNION ALL SELECT 'ae:A_par_' || CAST(p_partkey AS STRING) || '.t', {_PART_TARGET},
  'ae:A_' || p_brand || '.' || p_type || '.t' FROM {{part}} WHERE {_PART_TARGET} IS NOT NULL""",
    # ------------------------------------------------------------ imports and applications
    "raw_import": """
SELECT 'pkg:sup:' || CAST(s_suppkey AS STRING) AS importer, 'pkg:types' AS imported, 'Package' AS imported_kind
FROM {supplier}
UNION ALL SELECT 'pkg:sup:' || CAST(s_suppkey AS STRING), 'pkg:nat:' || CAST(s_nationkey AS STRING), 'Package'
FROM {supplier}
UNION ALL SELECT 'pkg:mm:' || p_brand, 'pkg:mm:business', 'Package' FROM {brand}
UNION ALL SELECT 'pkg:mm:' || p_brand, 'pkg:sup:' || CAST(l_suppkey AS STRING), 'Package' FROM {offer}
UNION ALL SELECT 'pf:' || source, 'pkg:mm:business', 'Package' FROM {source}
UNION ALL SELECT 'pf:' || source, 'pf:src0', 'Profile' FROM {source} WHERE source <> 'src0'
UNION ALL SELECT 'pf:' || source, 'pf:src19', 'Profile' FROM {source} WHERE source <> 'src19'""",
    "raw_application": """
SELECT 'urn:text:' || source AS resource, 'doc:' || CAST(doc_id AS STRING) AS element,
  'st:' || source || ':' || lang AS stereotype, 'pp:' || source || ':' || lang || '.base' AS base_property,
  'pf:' || source AS profile FROM {documents}
UNION ALL SELECT 'urn:text:' || source, 'doc:' || CAST(doc_id AS STRING), 'st:' || source || ':Quality',
  'pp:' || source || ':Quality.base_Document', 'pf:' || source FROM {labelled} WHERE quality = 1
UNION ALL SELECT 'urn:text:' || source, 'doc:' || CAST(doc_id AS STRING), 'st:' || source || ':Toxic',
  'pp:' || source || ':Toxic.base_Document', 'pf:' || source FROM {labelled} WHERE toxic = 1
UNION ALL SELECT 'urn:text:' || source, 'doc:' || CAST(doc_id AS STRING), 'st:Unknown', 'pp:Unknown', 'pf:' || source
FROM {labelled} WHERE quality = 0 AND toxic = 0
UNION ALL SELECT 'urn:text:' || source, 'doc:' || CAST(doc_id AS STRING), 'st:Orphan', 'pp:Orphan', NULL
FROM {documents} WHERE lang = 'de'""",
    "raw_profile_application": """
SELECT 'urn:text:' || source AS resource, 'pkg:text:' || source AS applying_package, 'pf:' || source AS applied_profile
FROM {source}
UNION ALL SELECT 'urn:text:' || source, CAST(NULL AS STRING), 'pf:' || source FROM {source}
UNION ALL SELECT 'urn:text:' || source, 'pkg:text:' || source, CAST(NULL AS STRING) FROM {source}""",
    # ------------------------------------------------------------ elements
    "element_row": "\n" + "\nUNION ALL ".join(ELEMENT_ROWS.values()),
    "raw_element": """
SELECT resource, uuid, kind, name, owner, is_abstract, 'T_' || uuid AS tool_id,
  coalesce(url, 'tool://' || uuid) AS tool_url FROM {element_row}""",
    # ------------------------------------------------------------ change events
    "raw_change": f"""
SELECT txn, seq, entity, true AS is_element, metaclass, property,
  CASE WHEN k < 30 THEN NULL
    WHEN property IN ('steps', 'status') THEN 'lit:Step.s0'
    WHEN property = 'cart' THEN 'par:' || CAST(k AS STRING)
    WHEN property = 'owner' THEN 'nat:0'
    ELSE CAST(CAST(value AS DECIMAL(18,2)) + 1 AS STRING) END AS old_value,
  CASE WHEN k % 7 = 0 THEN NULL
    WHEN property IN ('steps', 'status') THEN 'lit:Step.s' || CAST(k % 3 AS STRING)
    WHEN property = 'cart' AND k < 60 THEN 'par:' || CAST(k AS STRING)
    WHEN property = 'owner' THEN 'nat:' || CAST(k % 25 AS STRING)
    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS new_value,
  CASE WHEN property IN ('steps', 'status') AND k < 95 THEN 'literal'
    WHEN property = 'owner' OR (property = 'cart' AND k < 60) THEN 'element' ELSE 'atomic' END AS value_kind,
  CASE WHEN property = 'owner' THEN 'Nation' WHEN property = 'cart' AND k < 60 THEN 'Part' END AS value_metaclass,
  CASE k % 4 WHEN 0 THEN 'plain' WHEN 3 THEN 'position' ELSE 'indexed' END AS shape, k AS index
FROM (
  SELECT event_id AS seq, CAST(CAST(ts AS DATE) AS STRING) AS txn, value, k,
    'usr:' || CAST(user_id AS STRING) AS entity,
    CASE WHEN user_id % 5 = 0 THEN 'Ghost' ELSE 'User' END AS metaclass,
    CASE event_type WHEN 'signup' THEN 'INSTANCE_CREATED' WHEN 'click' THEN 'cart' WHEN 'view' THEN 'owner'
      WHEN 'error' THEN CASE WHEN k < 50 THEN 'BEFORE_DELETE' ELSE 'INSTANCE_DELETED' END
      ELSE CASE k % 5 WHEN 0 THEN 'scores' WHEN 1 THEN 'amount' WHEN 2 THEN 'steps'
        WHEN 3 THEN 'status' ELSE 'multiplicity' END END AS property
  FROM (SELECT event_id, ts, user_id, event_type, value, {JSON_K} AS k FROM {{events}}) AS e
) AS p""",
}

STAR_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
