"""Named SQL the per-query statements build on: the raw graph, then the derived relations.

A ``{name}`` refers to a star table or to another entry; everything is plain SQL for DuckDB.
"""

from __future__ import annotations

from modelweave.functions.expressions import PRIMITIVE_TYPES
from modelweave.plans.workspace import METAMODEL
from modelweave.sources.star import LINE_ORDER
from modelweave.sources.star_sql import JSON_K, STAR

_JSON_K_DUCKDB = "CAST(json_extract_string(props, '$.k') AS INT)"

BASE = {name: sql.replace(JSON_K, _JSON_K_DUCKDB) for name, sql in STAR.items()}

BASE["lineitem_at"] = f"""SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey
  ORDER BY {", ".join(LINE_ORDER)}) - 1 AS INT) AS idx FROM {{lineitem}}"""
BASE["raw_literal"] = """SELECT resource, enumeration, uuid, name,
  CAST(row_number() OVER (PARTITION BY enumeration ORDER BY name) - 1 AS INT) AS position FROM {literal_value}"""
BASE["user_act"] = f"""SELECT user_id, event_id, event_type, value, {_JSON_K_DUCKDB} AS k,
  CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS INT) AS nth
FROM {{events}} WHERE event_type IN ('purchase', 'view', 'click')"""
BASE["doc_line"] = """SELECT source, doc_id, words[CAST(i AS INT)] AS words, CAST(i - 1 AS INT) AS line
FROM (SELECT source, doc_id, string_split(text, chr(10)) AS words,
  unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM {documents}) AS s"""
BASE["vec_entry"] = """SELECT vec_id, embedding[CAST(i AS INT)] AS x, CAST(i - 1 AS INT) AS entry
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM {embeddings}) AS s"""

# ---------------------------------------------------------------- slots


def _s(column: str) -> str:
    return f"CAST({column} AS STRING)"


def _m(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS STRING)"


def _id(prefix: str, *columns: str) -> str:
    return f"'{prefix}:' || " + " || '.' || ".join(_s(c) for c in columns)


_LINE = _id("lin", "l_orderkey", "idx")


def _slot(source, resource, metaclass, entity, feature, kind, value="NULL", ref="NULL", instance="NULL",
          position="0", collection=False, where=""):
    return (
        f"SELECT {resource} AS resource, {entity} AS entity, '{metaclass}' AS metaclass, '{feature}' AS feature_name,"
        f" CAST({position} AS INT) AS position, {str(collection).lower()} AS is_collection, {kind} AS value_kind,"
        f" CAST({value} AS STRING) AS value, CAST({ref} AS STRING) AS ref, CAST({instance} AS STRING) AS ref_instance"
        f" FROM {{{source}}}{' WHERE ' + where if where else ''}"
    )


def _atomics(source, resource, metaclass, entity, **values):
    return [_slot(source, resource, metaclass, entity, f, "'atomic'", v) for f, v in values.items()]


def _literals(source, resource, metaclass, entity, **values):
    return [
        _slot(source, resource, metaclass, entity, f, "'literal'", f"'lit:{e}.' || {v}") for f, (e, v) in values.items()
    ]


def _refs(source, resource, metaclass, entity, feature, ref, position="0", collection=True):
    return [_slot(source, resource, metaclass, entity, feature, "'element'", ref=ref, position=position,
                  collection=collection)]


_T, _TEXT, _EV = "'urn:tpch'", "'urn:text:' || source", "'urn:events'"
_CUS, _SUP, _PAR, _ORD = _id("cus", "c_custkey"), _id("sup", "s_suppkey"), _id("par", "p_partkey"), _id("ord", "o_orderkey")
_USR, _DOC, _VEC, _TUR = _id("usr", "user_id"), _id("doc", "doc_id"), _id("vec", "vec_id"), _id("tur", "conv_id", "turn")

BASE["raw_slot"] = "\nUNION ALL ".join([
    *_atomics("region", _T, "Region", _id("reg", "r_regionkey"), name="r_name"),
    *_atomics("nation", _T, "Nation", _id("nat", "n_nationkey"), name="n_name"),
    *_refs("nation", _T, "Region", _id("reg", "n_regionkey"), "nations", _id("nat", "n_nationkey"), "n_nationkey"),
    *_atomics("customer", _T, "Customer", _CUS, name="c_name", acctbal=_m("c_acctbal")),
    *_literals("customer", _T, "Customer", _CUS, mktsegment=("MarketSegment", "c_mktsegment")),
    _slot("customer", _T, "Customer", _CUS, "wallet", "'instance'", ref=_id("val", "c_custkey"),
          instance=f"CASE WHEN c_acctbal > 0 THEN {_id('mon:cus', 'c_custkey')} END"),
    *_refs("customer", _T, "Customer", _CUS, "home", _id("nat", "c_nationkey"), collection=False),
    *_refs("customer", _T, "Nation", _id("nat", "c_nationkey"), "customers", _CUS),
    *_atomics("supplier", _T, "Supplier", _SUP, name="s_name", acctbal=_m("s_acctbal")),
    *_refs("supplier", _T, "Nation", _id("nat", "s_nationkey"), "suppliers", _SUP),
    *_refs("supplier", _T, "Nation", _id("nat", "s_nationkey"), "parties", _SUP),
    *_atomics("part", _T, "Part", _PAR, name="p_name", brand="p_brand", ptype="p_type", size=_s("p_size"),
              retailprice=_m("p_retailprice")),
    *_atomics("orders", _T, "Order", _ORD, orderyear="year(o_orderdate)", totalprice=_m("o_totalprice")),
    *_literals("orders", _T, "Order", _ORD, orderstatus=("OrderStatus", "o_orderstatus"),
               orderpriority=("Priority", "o_orderpriority")),
    _slot("orders", _T, "Order", _ORD, "total", "'instance'", ref=_id("val:ord", "o_orderkey"),
          instance=_id("mon:ord", "o_orderkey")),
    *_refs("orders", _T, "Customer", _id("cus", "o_custkey"), "orders", _ORD),
    *_atomics("lineitem_at", _T, "LineItem", _LINE, quantity=_m("l_quantity"), extendedprice=_m("l_extendedprice"),
              discount=_m("l_discount"), tax=_m("l_tax"), shipdate=_s("CAST(l_shipdate AS DATE)")),
    *_literals("lineitem_at", _T, "LineItem", _LINE, returnflag=("ReturnFlag", "l_returnflag"),
               linestatus=("LineStatus", "l_linestatus")),
    _slot("lineitem_at", _T, "LineItem", _LINE, "charges", "'instance'", ref=f"'chg:t:' || {_LINE}",
          instance=f"CASE WHEN l_discount > 0 THEN 'chg:discount:' || {_LINE} END", collection=True),
    _slot("lineitem_at", _T, "LineItem", _LINE, "charges", "'instance'", ref=f"'chg:t:' || {_LINE}",
          instance=f"'chg:tax:' || {_LINE}", position="1", collection=True),
    *_refs("lineitem_at", _T, "Order", _id("ord", "l_orderkey"), "items", _LINE, "idx"),
    *_refs("lineitem_at", _T, "Part", _id("par", "l_partkey"), "uses", _LINE),
    *_atomics("documents", _TEXT, "Document", _DOC, nchars=_s("n_chars")),
    *_literals("documents", _TEXT, "Document", _DOC, lang=("Lang", "lang")),
    _slot("doc_line", _TEXT, "Document", _DOC, "lines", "'atomic'", "words", position="line", collection=True),
    *_refs("conversations", "'urn:dialog'", "Conversation", _id("con", "conv_id"), "turns", _TUR, "turn"),
    *_literals("conversations", "'urn:dialog'", "Turn", _TUR, role=("Role", "role")),
    *_atomics("conversations", "'urn:dialog'", "Turn", _TUR, text="text"),
    *_atomics("pages", "'urn:web'", "Page", _id("pag", "page_id"), html="html"),
    _slot("vec_entry", "'urn:vectors'", "Vector", _VEC, "embedding", "'atomic'",
          "printf('%.8e', CAST(x AS DOUBLE))", position="entry", collection=True),
    *_atomics("embeddings", "'urn:vectors'", "Vector", _VEC, label=_s("label")),
    _slot("user_act", _EV, "User", _USR, "scores", "'atomic'", _m("value"), position="nth", collection=True,
          where="event_type = 'purchase'"),
    _slot("user_act", _EV, "User", _USR, "steps", "CASE WHEN k < 80 THEN 'literal' ELSE 'atomic' END",
          "'lit:Step.s' || CAST(k % 3 AS STRING)", position="nth", collection=True, where="event_type = 'view'"),
    _slot("user_act", _EV, "User", _USR, "cart", "CASE WHEN k < 90 THEN 'element' ELSE 'atomic' END",
          "CASE WHEN k >= 90 THEN 'gift' END", ref=f"CASE WHEN k < 90 THEN {_id('par', 'event_id')} END",
          position="nth", collection=True, where="event_type = 'click'"),
])


def _tag(feature, kind, value="NULL", ref="NULL", instance="NULL", position="0"):
    return (
        f"SELECT 'urn:text:' || source AS resource, {_DOC} AS entity, 'pp:' || source || ':{feature}' AS feature,"
        f" {position} AS position, {kind} AS value_kind, CAST({value} AS STRING) AS value,"
        f" CAST({ref} AS STRING) AS ref, CAST({instance} AS STRING) AS ref_instance FROM {{labelled}}"
    )


def _doc(step: int) -> str:
    return f"'doc:' || CAST(doc_id + {step} AS STRING)"


BASE["raw_tag_slot"] = "\nUNION ALL ".join([
    _tag("Scored.note", "'atomic'", "lang"),
    _tag("Quality.flag", "'atomic'", "'true'"),
    _tag("Quality.evidence", "'element'", ref=_doc(1)),
    _tag("Quality.evidence", "'instance'", ref=_doc(0), instance=_doc(2), position="1"),
    _tag("Quality.rank", "'atomic'", "n_chars"),
    _tag("Quality.langs", "'atomic'", "'any'"),
    _tag("Quality.langs", "'literal'", "'lit:Lang.' || lang", position="1"),
    _tag("Quality.price", "'instance'", ref=_doc(0), instance=_doc(0)),
    _tag("Toxic.related", "'element'", ref=_doc(3)),
    _tag("Toxic.related", "CASE WHEN quality = 0 THEN 'atomic' ELSE 'element' END",
         "CASE WHEN quality = 0 THEN 'n/a' END", ref=f"CASE WHEN quality <> 0 THEN {_doc(4)} END", position="1"),
])

# ---------------------------------------------------------------- metamodel

_PRIMITIVES = ", ".join(f"('{name}', '{xsd}')" for name, xsd in PRIMITIVE_TYPES.items())

BASE |= {
    "selected_doc": """SELECT d.* FROM {raw_selection} s JOIN {raw_document} d ON s.scope_package = d.scope_package""",
    "primitive_map": f"SELECT * FROM (VALUES {_PRIMITIVES}) AS t(name, xsd)",
    "m_class": """SELECT resource, uuid, name, is_abstract FROM {raw_element}
WHERE kind = 'Class' AND resource IN (SELECT resource FROM {raw_document} WHERE kind = 'Metamodel')""",
    "b_class": f"SELECT * FROM {{m_class}} WHERE resource = '{METAMODEL}'",
    "oriented": """
SELECT resource, association, name, is_abstract,
  CASE WHEN swap THEN b_uuid ELSE a_uuid END AS source_end, CASE WHEN swap THEN a_uuid ELSE b_uuid END AS target_end,
  CASE WHEN swap THEN b_name ELSE a_name END AS source_name, CASE WHEN swap THEN a_name ELSE b_name END AS target_name,
  CASE WHEN swap THEN b_type ELSE a_type END AS source_class, CASE WHEN swap THEN a_type ELSE b_type END AS target_class,
  CASE WHEN swap THEN b_lower ELSE a_lower END AS source_lower, CASE WHEN swap THEN a_lower ELSE b_lower END AS target_lower,
  CASE WHEN swap THEN b_upper ELSE a_upper END AS source_upper, CASE WHEN swap THEN a_upper ELSE b_upper END AS target_upper,
  CASE WHEN swap THEN b_ordered ELSE a_ordered END AS source_ordered,
  CASE WHEN swap THEN a_ordered ELSE b_ordered END AS target_ordered,
  CASE WHEN swap THEN a_composite ELSE b_composite END AS target_composite
FROM (
  SELECT r.resource, r.uuid AS association, r.name, r.is_abstract,
    starts_with(b.name, '_') OR starts_with(b.name, 'UML') AS swap,
    a.uuid AS a_uuid, b.uuid AS b_uuid, a.name AS a_name, b.name AS b_name, a.type AS a_type, b.type AS b_type,
    a.lower AS a_lower, b.lower AS b_lower, a.upper AS a_upper, b.upper AS b_upper,
    a.is_ordered AS a_ordered, b.is_ordered AS b_ordered, a.is_composite AS a_composite, b.is_composite AS b_composite
  FROM {raw_association} r JOIN {raw_feature} a ON r.end1 = a.uuid JOIN {raw_feature} b ON r.end2 = b.uuid) AS e""",
    "assoc_gen": """
SELECT DISTINCT a.resource, a.association AS specific, g.association AS general,
  rs.rel = 'redefines' AS "sourceRestriction", rt.rel = 'redefines' AS "targetRestriction"
FROM {oriented} a JOIN {raw_feature_rel} rs ON rs.feature = a.source_end
JOIN {oriented} g ON g.source_end = rs.target
JOIN {raw_feature_rel} rt ON rt.feature = a.target_end AND rt.target = g.target_end""",
    "class_attr": """
SELECT f.resource, f.owner, f.uuid, f.name, f.type, f.lower, f.upper, f.is_ordered, f.is_derived,
  CAST(f.idx AS INT) AS idx, CASE t.type_kind WHEN 'primitive' THEN 'atomic' ELSE t.type_kind END AS kind
FROM (
  SELECT *, row_number() OVER (PARTITION BY owner ORDER BY position, uuid) - 1 AS idx, 'primitive' AS numbered_kind
  FROM {raw_feature} WHERE NOT is_derived
  UNION ALL SELECT *, row_number() OVER (PARTITION BY owner ORDER BY position, uuid) - 1, 'other' FROM {raw_feature}
) f JOIN {raw_type} t ON t.uuid = f.type
WHERE f.owner IN (SELECT uuid FROM {m_class}) AND t.type_kind IN ('primitive', 'enumeration', 'structured')
  AND (t.type_kind = 'primitive') = (f.numbered_kind = 'primitive')""",
    "bounded": """
SELECT resource, source_end AS feature, source_lower AS lower, source_upper AS upper, source_ordered AS "isOrdered"
FROM {oriented}
UNION ALL SELECT resource, target_end, target_lower, target_upper, target_ordered FROM {oriented}
UNION ALL SELECT resource, uuid, lower, upper, is_ordered FROM {class_attr}""",
    "taxa": """
SELECT a.metaclass, c.name AS metaclass_name, a.supertype, s.name AS supertype_name, a.depth, l.level
FROM (SELECT metaclass, supertype, CAST(min(depth) AS INT) AS depth FROM {ancestor} GROUP BY 1, 2) a
JOIN (SELECT metaclass, CAST(count(DISTINCT supertype) AS INT) AS level FROM {ancestor} GROUP BY 1) l
  ON l.metaclass = a.supertype
JOIN {m_class} c ON c.uuid = a.metaclass JOIN {m_class} s ON s.uuid = a.supertype""",
    "effective": """
SELECT x.metaclass, x.metaclass_name, a.uuid AS attribute, a.name, a.type, a.kind, a.is_ordered, a.is_derived,
  a.owner, x.depth, x.level
FROM {taxa} x JOIN {class_attr} a ON a.owner = x.supertype""",
    "attr_lookup": """
SELECT e.metaclass, e.metaclass_name, e.name, e.attribute, e.kind, e.is_ordered, e.type,
  i.uuid AS implementation, i.is_ordered AS implementation_ordered, i.is_derived AS implementation_derived
FROM (SELECT *, row_number() OVER (PARTITION BY metaclass, kind, is_ordered, name ORDER BY level DESC, attribute) AS r
  FROM {effective}) e
JOIN (SELECT x.metaclass, f.name, f.uuid, f.is_ordered, f.is_derived,
    row_number() OVER (PARTITION BY x.metaclass, f.name ORDER BY x.level DESC, f.uuid) AS r
  FROM {taxa} x JOIN {raw_feature} f ON f.owner = x.supertype WHERE f.opposite IS NULL) i
  ON i.metaclass = e.metaclass AND i.name = e.name
WHERE e.r = 1 AND i.r = 1""",
    # ------------------------------------------------------------ associations by direction
    "views": """
SELECT o.resource, o.association, o.name, o.source_end, o.source_name, o.source_class, s.name AS source_class_name,
  o.target_end, o.target_name, o.target_class, t.name AS target_class_name, o.target_ordered AS is_ordered,
  o.target_composite
FROM {oriented} o JOIN {m_class} s ON s.uuid = o.source_class JOIN {m_class} t ON t.uuid = o.target_class""",
    "matched": """
SELECT p.owner AS holder, v.association, p.uuid AS feature, p.name AS feature_name, po.uuid AS opposite,
  po.name AS opposite_name, po.type AS source_class, v.source_class_name, p.type AS target_class,
  v.target_class_name, v.is_ordered,
  p.is_containment AND p.is_changeable AND po.is_container AND po.is_changeable AS contains,
  NOT p.is_container AND NOT p.is_containment AND NOT p.is_derived
    AND NOT po.is_container AND NOT po.is_containment AND NOT po.is_derived AS refers
FROM {raw_feature} p JOIN {raw_feature} po ON p.opposite = po.uuid
JOIN {m_class} tc ON tc.uuid = p.type JOIN {m_class} sc ON sc.uuid = po.type
JOIN {views} v ON v.source_name = po.name AND v.source_class_name = sc.name
  AND v.target_name = p.name AND v.target_class_name = tc.name""",
    "cf": """
SELECT * FROM (
  SELECT x.metaclass, x.metaclass_name, split_part(m.feature_name, '__from_', 1) AS key, m.*,
    row_number() OVER (PARTITION BY x.metaclass, split_part(m.feature_name, '__from_', 1)
      ORDER BY x.level DESC, CASE WHEN contains(m.feature_name, '__from_') THEN 0 ELSE 1 END, m.association) AS r
  FROM {taxa} x JOIN {matched} m ON m.holder = x.supertype WHERE m.contains) AS c WHERE r = 1""",
    "rf": """
SELECT * FROM (
  SELECT x.metaclass, x.metaclass_name, m.feature_name AS key, m.*,
    row_number() OVER (PARTITION BY x.metaclass, m.feature_name ORDER BY x.level DESC, m.association) AS r
  FROM {taxa} x JOIN {matched} m ON m.holder = x.supertype WHERE m.refers) AS c WHERE r = 1""",
    "cr": """
SELECT * FROM (
  SELECT x.metaclass, x.metaclass_name, m.feature_name AS key, x.depth, m.*,
    row_number() OVER (PARTITION BY x.metaclass, m.feature_name ORDER BY x.depth, m.association) AS r
  FROM {taxa} x JOIN {matched} m ON m.target_class = x.supertype WHERE m.contains) AS c WHERE r = 1""",
    "rr": """
SELECT * FROM (
  SELECT x.metaclass, x.metaclass_name, m.feature_name AS key, x.depth, m.*,
    row_number() OVER (PARTITION BY x.metaclass, m.feature_name ORDER BY x.depth, m.association) AS r
  FROM {taxa} x JOIN {matched} m ON m.target_class = x.supertype WHERE m.refers) AS c WHERE r = 1""",
    "forward": """
SELECT metaclass, metaclass_name, key, association, feature_name, opposite_name, source_class_name, target_class_name,
  is_ordered, 0 AS rank FROM {cf}
UNION ALL SELECT metaclass, metaclass_name, key, association, feature_name, opposite_name, source_class_name,
  target_class_name, is_ordered, 1 FROM {rf}""",
    "inverse": """
SELECT metaclass, metaclass_name, opposite_name AS key, association, feature_name, opposite_name, source_class_name,
  target_class_name, depth, 2 AS rank FROM {cr}
UNION ALL SELECT metaclass, metaclass_name, opposite_name, association, feature_name, opposite_name, source_class_name,
  target_class_name, depth, 3 FROM {rr}""",
    "routes": """
SELECT metaclass_name, key, association, rank, feature_name, opposite_name, source_class_name, target_class_name
FROM (SELECT *, row_number() OVER (PARTITION BY metaclass, key ORDER BY rank, depth, association) AS r FROM (
  SELECT metaclass, metaclass_name, key, association, rank, feature_name, opposite_name, source_class_name,
    target_class_name, 0 AS depth FROM {forward}
  UNION ALL SELECT metaclass, metaclass_name, key, association, rank, feature_name, opposite_name, source_class_name,
    target_class_name, depth FROM {inverse}) AS b) AS f WHERE r = 1""",
    # ------------------------------------------------------------ profiles
    "stereo": """SELECT e.resource, e.uuid, e.name, e.is_abstract FROM {raw_element} e
JOIN {selected_doc} d ON d.resource = e.resource WHERE e.kind = 'Stereotype' AND d.kind = 'Profile'""",
    "stereo_prop": """
SELECT s.resource, f.uuid, f.owner, f.position, f.name, f.type, f.lower, f.upper, f.is_ordered, f.is_derived,
  f.is_composite, f.is_extension_end, t.type_kind, t.name AS type_name,
  CAST(row_number() OVER (PARTITION BY f.owner ORDER BY f.position, f.uuid) - 1 AS INT) AS idx
FROM {raw_feature} f JOIN {stereo} s ON s.uuid = f.owner LEFT JOIN {raw_type} t ON t.uuid = f.type""",
    "stereo_attr": """
SELECT p.resource, p.owner, p.uuid, p.name, l.uuid AS library_type, p.lower, p.upper, p.is_ordered, p.idx
FROM {stereo_prop} p JOIN {raw_datatype} l ON l.name = p.type_name AND l.resource = 'urn:lib:types'
WHERE p.type_kind IN ('primitive', 'enumeration', 'structured')""",
    "class_prop": """
SELECT p.*, c.uuid AS target FROM {stereo_prop} p LEFT JOIN {b_class} c ON c.name = p.type_name
WHERE NOT p.is_derived AND NOT p.is_extension_end AND p.type_kind = 'class'""",
    "stereo_stereo": """
SELECT p.* FROM {stereo_prop} p JOIN {stereo} s ON s.uuid = p.type AND s.resource = p.resource
WHERE NOT p.is_derived""",
    "profile_end": """
SELECT resource, uuid, name, lower, upper, is_ordered, is_composite FROM {class_prop} WHERE target IS NOT NULL
UNION ALL SELECT resource, uuid, name, lower, upper, is_ordered, is_composite FROM {stereo_stereo}""",
    # ------------------------------------------------------------ models
    "model_element": """SELECT * FROM {raw_element}
WHERE resource IN (SELECT resource FROM {raw_document} WHERE kind = 'Model')""",
    "app_count": """
SELECT resource, profile, stereotype, base_property, count(DISTINCT element) AS applications
FROM {raw_application} GROUP BY 1, 2, 3, 4""",
    "profile_use": """
SELECT a.resource, a.profile, d.resource AS profile_resource, x.resource AS exported
FROM (SELECT DISTINCT resource, profile FROM {raw_application} WHERE profile IS NOT NULL) a
LEFT JOIN {raw_document} d ON d.scope_package = a.profile
LEFT JOIN {selected_doc} x ON x.resource = d.resource AND x.kind = 'Profile'""",
    "application": """
SELECT a.*, s.uuid AS known FROM {raw_application} a
JOIN {profile_use} u ON u.resource = a.resource AND u.profile = a.profile AND u.exported IS NOT NULL
LEFT JOIN {stereo} s ON s.resource = u.profile_resource AND s.uuid = a.stereotype""",
    "application_error": """
SELECT resource, stereotype AS element, 'error' AS severity, 'stereotype-without-profile' AS code,
  'Stereotype without a profile ' || stereotype || ': ' || CAST(applications AS STRING) || ' applications' AS message
FROM {app_count} WHERE profile IS NULL
UNION ALL SELECT resource, profile, 'error', 'profile-without-document', 'No document for profile ' || profile
FROM {profile_use} WHERE profile_resource IS NULL
UNION ALL SELECT resource, profile, 'error', 'profile-not-exported', 'Profile is not exported: ' || profile
FROM {profile_use} WHERE profile_resource IS NOT NULL AND exported IS NULL
UNION ALL SELECT resource, stereotype, 'error', 'unknown-stereotype',
  'Unknown stereotype ' || stereotype || ': ' || CAST(count(DISTINCT element) AS STRING) || ' applications'
FROM {application} WHERE known IS NULL GROUP BY resource, stereotype, base_property, profile""",
    "element_error": """
SELECT e.resource, e.uuid AS element, 'fatal' AS severity, 'unknown-metaclass' AS code,
  'Element of an unknown metaclass: ' || e.kind AS message
FROM {model_element} e LEFT JOIN {b_class} c ON c.name = e.kind WHERE c.uuid IS NULL""",
    "package_error": """
SELECT CAST(NULL AS STRING) AS resource, CAST(NULL AS STRING) AS element, 'error' AS severity,
  'package-not-found' AS code, 'No package or profile found with tool id ' || c.tool_package_id AS message
FROM {raw_configuration} c
LEFT JOIN {raw_element} e ON e.tool_id = c.tool_package_id AND e.kind IN ('Package', 'Profile')
WHERE e.uuid IS NULL""",
    # ------------------------------------------------------------ values, links
    "value_row": """
SELECT s.resource, s.entity, l.attribute, l.kind, l.is_ordered, s.value_kind, s.value, s.ref, s.ref_instance,
  CASE WHEN s.is_collection THEN s.position ELSE 0 END AS idx
FROM {raw_slot} s JOIN {attr_lookup} l ON l.metaclass_name = s.metaclass AND l.name = s.feature_name
WHERE NOT l.implementation_derived AND l.metaclass IN (SELECT uuid FROM {b_class})""",
    "link_row": """
SELECT s.resource, s.entity, s.feature_name, s.position, s.is_collection, s.value_kind, s.ref, f.association,
  f.is_ordered
FROM {raw_slot} s JOIN {forward} f ON f.metaclass_name = s.metaclass AND f.feature_name = s.feature_name
WHERE f.metaclass IN (SELECT uuid FROM {b_class})""",
    "stereo_parent": """
SELECT uuid AS stereotype, uuid AS holder FROM {raw_stereotype}
UNION SELECT g.specific, g.general FROM {raw_generalization} g JOIN {raw_stereotype} s ON s.uuid = g.specific""",
    "tag_row": """
SELECT s.*, f.is_ordered, t.type_kind
FROM {raw_tag_slot} s JOIN {raw_feature} f ON f.uuid = s.feature LEFT JOIN {raw_type} t ON t.uuid = f.type
WHERE EXISTS (SELECT 1 FROM {raw_application} a JOIN {stereo_parent} p ON p.stereotype = a.stereotype
  WHERE a.element = s.entity AND p.holder = f.owner)""",
    "tag_ref": """
SELECT resource, entity, feature, position, is_ordered,
  CASE value_kind WHEN 'element' THEN ref WHEN 'instance' THEN ref_instance END AS target
FROM {tag_row} WHERE type_kind IN ('class', 'stereotype')""",
    "tag_ref_error": """
SELECT resource, entity AS element, 'error' AS severity, 'reference-value' AS code,
  'Value of ' || feature || ' refers to no element, index=' || CAST(position AS STRING) AS message, is_ordered
FROM {tag_ref} WHERE target IS NULL""",
    "tag_error": """
SELECT resource, entity AS element, 'error' AS severity, 'structured-tag-unsupported' AS code,
  'Structured value of ' || feature || ' is not supported: value=' || coalesce(ref_instance, 'null') ||
  ', index=' || CAST(position AS STRING) AS message
FROM {tag_row} WHERE is_ordered AND value_kind = 'instance'
  AND (type_kind IS NULL OR type_kind NOT IN ('primitive', 'enumeration'))""",
    "link_error": """
SELECT resource, entity AS element, 'error' AS severity, 'link-to-non-element' AS code,
  'No element at ' || feature_name || '[' || CAST(position AS STRING) || ']' AS message
FROM {link_row} WHERE is_collection AND value_kind <> 'element'""",
}
