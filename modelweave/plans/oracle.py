"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

import string

from modelweave.operators.changes import IGNORED_PROPERTIES, VALUE_EVENTS
from modelweave.operators.metamodel import KINDS, RESTRICTIONS
from modelweave.operators.model import TOOL_VENDOR
from modelweave.plans.oracle_base import BASE
from modelweave.plans.workspace import METAMODEL
from modelweave.schemas import ERRORS, FAMILIES
from modelweave.sources.star_sql import STAR_TABLES

_IGNORED = ", ".join(f"'{p}'" for p in IGNORED_PROPERTIES)

CHANGES = {
    "relevant": f"SELECT * FROM {{raw_change}} WHERE is_element AND property NOT IN ({_IGNORED})",
    "routed": """
SELECT c.*, r.association, r.feature_name, r.opposite_name, r.source_class_name, r.target_class_name,
  CASE WHEN c.property = 'INSTANCE_CREATED' THEN 'created' WHEN c.property = 'BEFORE_DELETE' THEN 'before delete'
    WHEN c.property = 'INSTANCE_DELETED' THEN 'deleted' WHEN r.rank < 2 THEN 'forward'
    WHEN r.rank >= 2 THEN 'inverse' ELSE 'attribute' END AS route,
  c.entity || ' : ' || c.property || ' => Old value: ' || coalesce(c.old_value, 'null') || ', new value: '
    || coalesce(c.new_value, 'null') AS description
FROM {relevant} c LEFT JOIN {routes} r ON r.metaclass_name = c.metaclass AND r.key = c.property""",
    "element_change": """
SELECT r.txn, r.seq, CASE r.route WHEN 'created' THEN 'AddedChange' ELSE 'DeletedChange' END AS "changeKind",
  '' AS resource, r.entity AS uuid, c.uuid AS "metaClass", r.description
FROM {routed} r JOIN {b_class} c ON c.name = r.metaclass AND NOT c.is_abstract
WHERE r.route IN ('created', 'deleted')""",
    "kind_value": """
SELECT txn, seq, CASE WHEN old_value IS NULL AND new_value IS NOT NULL THEN 'AddedChange'
    WHEN old_value IS NOT NULL AND new_value IS NULL THEN 'DeletedChange' ELSE 'ModifiedChange' END AS kind,
  CASE WHEN new_value IS NULL THEN old_value ELSE new_value END AS value
FROM {relevant}""",
    "value_change": """
SELECT r.txn, r.seq, k.kind AS "changeKind", '' AS resource, r.entity, l.attribute, k.value, r.index,
  l.kind, l.is_ordered, r.description
FROM {routed} r JOIN {kind_value} k ON k.seq = r.seq
JOIN {attr_lookup} l ON l.metaclass_name = r.metaclass AND l.name = r.property
WHERE r.route = 'attribute' AND r.shape IN ('indexed', 'position') AND l.implementation_ordered = l.is_ordered
  AND (l.kind = 'atomic' OR (l.kind = 'enumeration' AND r.value_kind = 'literal' AND k.value IS NOT NULL))""",
    "link_change": """
SELECT r.txn, r.seq, r.entity, r.property, r.association, r.route,
  CASE WHEN r.old_value IS NULL AND r.new_value IS NOT NULL AND ok THEN 'new'
    WHEN r.old_value IS NOT NULL AND r.new_value IS NULL AND ok THEN 'del' ELSE 'unknown' END AS "linkChange",
  r.source_class_name || '::' || r.opposite_name || ' -> ' || r.feature_name || '::' || r.target_class_name AS path
FROM (SELECT q.*, q.value_kind = 'element' AND EXISTS (SELECT 1 FROM {taxa} x
    WHERE x.metaclass_name = q.value_metaclass AND x.supertype_name =
      CASE q.route WHEN 'forward' THEN q.target_class_name ELSE q.source_class_name END) AS ok
  FROM {routed} q WHERE q.route IN ('forward', 'inverse')) AS r""",
    "record": "SELECT txn, seq, 'ModelElementChangedEvent' AS event, \"changeKind\", resource, uuid AS entity,"
    " \"metaClass\", CAST(NULL AS STRING) AS attribute, CAST(NULL AS STRING) AS value, CAST(NULL AS INT) AS index,"
    " description FROM {element_change}\n" + "\n".join(
        f"UNION ALL SELECT txn, seq, '{name}', \"changeKind\", resource, entity, NULL, attribute, value,"
        f" {'index' if ordered else 'NULL'}, description FROM {{value_change}}"
        f" WHERE kind = '{kind}' AND is_ordered = {str(ordered).lower()}"
        for (kind, ordered), name in VALUE_EVENTS.items()
    ),
}

_TREE = """ancestor(metaclass, supertype, depth) AS (
  SELECT uuid, uuid, 0 FROM m_class
  UNION SELECT a.metaclass, g.general, a.depth + 1 FROM ancestor a
    JOIN raw_generalization g ON g.specific = a.supertype JOIN m_class c ON c.uuid = g.general)"""

_REACH = """reach(node, depth) AS (
  SELECT scope_package, 0 FROM raw_selection
  UNION SELECT e.dst, r.depth + 1 FROM reach r JOIN (
      SELECT importer AS src, imported AS dst FROM raw_import
      UNION SELECT applying_package, applied_profile FROM raw_profile_application
      WHERE applying_package IS NOT NULL AND applied_profile IS NOT NULL) e ON e.src = r.node
    WHERE r.depth < 10)"""

_WALK = """walk(missing, depth, node, path) AS (
  SELECT node, depth, node, node FROM dep_reach WHERE node NOT IN (SELECT scope_package FROM raw_selection)
  UNION ALL SELECT w.missing, w.depth, v.via, v.via || ' > ' || w.path FROM walk w JOIN dep_via v ON v.node = w.node)"""

_PART_TREE = """part_tree(specific, general) AS (
  SELECT specific, general FROM part_edge
  UNION SELECT t.specific, e.general FROM part_tree t JOIN part_edge e ON e.specific = t.general)"""

_RECURSIVE = {"ancestor": (_TREE, ("m_class", "raw_generalization")),
              "reach": (_REACH, ("raw_selection", "raw_import", "raw_profile_application")),
              "walk": (_WALK, ("dep_reach", "dep_via", "raw_selection")), "part_tree": (_PART_TREE, ("part_edge",))}

CHECKS = {
    "dep_edge": """SELECT importer AS src, imported AS dst FROM {raw_import}
UNION SELECT applying_package, applied_profile FROM {raw_profile_application}
WHERE applying_package IS NOT NULL AND applied_profile IS NOT NULL""",
    "dep_reach": "SELECT node, CAST(min(depth) AS INT) AS depth FROM {reach} GROUP BY node",
    "dep_via": """SELECT e.dst AS node, min(e.src) AS via FROM {dep_edge} e
JOIN {dep_reach} a ON a.node = e.src JOIN {dep_reach} b ON b.node = e.dst WHERE b.depth = a.depth + 1 GROUP BY 1""",
    "part_edge": """SELECT 'par:' || CAST(p_partkey AS STRING) AS specific, 'par:' || CAST(above AS STRING) AS general
FROM (SELECT DISTINCT p_partkey, CASE WHEN p_partkey % 10 = 9 THEN p_partkey + 1 WHEN p_partkey % 100 = 0 THEN p_partkey
    WHEN p_partkey % 10 = 0 THEN p_partkey - 1 ELSE p_partkey // 3 END AS above FROM {part}) AS e
WHERE above IN (SELECT p_partkey FROM {part})""",
    "part_cycle": """SELECT a.specific AS node, min(a.general) AS component FROM {part_tree} a
JOIN {part_tree} b ON b.specific = a.general AND b.general = a.specific GROUP BY 1""",
    "candidate": """SELECT DISTINCT x.metaclass, n.key, n.holder FROM {taxa} x JOIN (
  SELECT holder, feature_name AS key FROM {matched} WHERE refers UNION SELECT owner, name FROM {class_attr}
  UNION SELECT supertype, 'kind' FROM {taxa} WHERE metaclass <> supertype) n ON n.holder = x.supertype""",
    "minimal": """SELECT c.* FROM {candidate} c WHERE NOT EXISTS (
  SELECT 1 FROM {candidate} d JOIN {taxa} t ON t.metaclass = d.holder
  WHERE d.metaclass = c.metaclass AND d.key = c.key AND t.supertype = c.holder AND d.holder <> c.holder)""",
}

_KIND_DOC = "resource IN (SELECT resource FROM {{raw_document}} WHERE kind = '{}')"

STATEMENTS = {
    # ------------------------------------------------------------ documents and selection
    "select_kind": "SELECT resource, uuid, kind, name FROM {element_row} WHERE kind IN ('Customer', 'Supplier')",
    "select_kind_of": """SELECT resource, uuid, kind, name FROM {element_row}
WHERE kind IN (SELECT metaclass_name FROM {taxa} WHERE supertype_name = 'Party')""",
    "resource_rows": "SELECT resource, kind FROM {raw_document}",
    "entity_identities": "SELECT resource, uuid FROM {raw_element} WHERE uuid IS NOT NULL",
    "split_profiles_packages": """SELECT resource, uuid, name, kind FROM {raw_element}
WHERE kind IN ('Profile', 'Package') AND uuid IN (SELECT scope_package FROM {raw_selection})""",
    "lookup_document_packages": """SELECT c.tool_package_id, e.resource, e.uuid, e.kind
FROM {raw_configuration} c JOIN {raw_element} e ON e.tool_id = c.tool_package_id
WHERE e.kind IN ('Package', 'Profile')""",
    "lookup_document_package_errors": "SELECT * FROM {package_error}",
    "document_config_rows": """SELECT d.package_uri AS "packageURI", d.document_url AS "documentURL",
  d.artifact_kind AS "artifactKind", d.ns_prefix AS "nsPrefix", d.uuid_prefix AS "uuidPrefix",
  e.tool_id AS "toolSpecificPackageID", e.tool_url AS "toolSpecificPackageURL"
FROM {raw_document} d JOIN {raw_element} e ON e.uuid = d.scope_package AND e.kind IN ('Package', 'Profile')""",
    "export_per_document": "SELECT resource, scope_package, kind FROM {selected_doc}",
    "export_per_document_errors": """SELECT CAST(NULL AS STRING) AS resource, scope_package AS element,
  'error' AS severity, 'no-document' AS code, 'No document for the selected package ' || scope_package AS message
FROM {raw_selection} WHERE scope_package NOT IN (SELECT scope_package FROM {raw_document})""",
    "missing_dependencies": """SELECT node AS missing, CAST(min(depth) AS INT) AS depth FROM {reach}
WHERE node NOT IN (SELECT scope_package FROM {raw_selection}) GROUP BY node""",
    # ------------------------------------------------------------ library
    "primitive_types": """SELECT t.resource, t.uuid, t.name, m.xsd AS "datatypeMapDefinition"
FROM {raw_type} t JOIN {primitive_map} m ON m.name = t.name WHERE t.type_kind = 'primitive'""",
    "primitive_type_errors": """SELECT t.resource, t.uuid AS element, 'fatal' AS severity, 'unknown-primitive' AS code,
  'No datatype is known for the primitive type ' || t.name AS message
FROM {raw_type} t LEFT JOIN {primitive_map} m ON m.name = t.name WHERE t.type_kind = 'primitive' AND m.xsd IS NULL""",
    "enumeration_types": "SELECT resource, uuid, name FROM {raw_type} WHERE type_kind = 'enumeration'",
    "enumeration_literals_indexed":
        "SELECT resource, enumeration, uuid AS literal, position AS index FROM {raw_literal}",
    "enumeration_literal_names": "SELECT resource, uuid AS literal, name FROM {raw_literal}",
    "library_import_warnings": """SELECT o.resource, i.importer AS element, 'warning' AS severity,
  'import-without-document' AS code,
  i.importer || ' imports a package without a known document: ' || i.imported AS message
FROM {raw_import} i JOIN {raw_document} o ON o.scope_package = i.importer AND o.kind = 'Library'
LEFT JOIN {raw_document} d ON d.scope_package = i.imported WHERE d.resource IS NULL""",
    # ------------------------------------------------------------ metamodel
    "meta_classes": 'SELECT resource, uuid, name, is_abstract AS "isAbstract" FROM {m_class}',
    "meta_associations": 'SELECT resource, uuid, name, is_abstract AS "isAbstract" FROM {raw_association}',
    "orient_associations": """SELECT resource, association, name, source_end, source_name, source_class, target_end,
  target_name, target_class FROM {oriented}""",
    "assoc_generalizations": "SELECT * FROM {assoc_gen}",
    "metaclass_generalizations": """SELECT s.resource, g.specific, g.general FROM {raw_generalization} g
JOIN {m_class} s ON s.uuid = g.specific JOIN {m_class} p ON p.uuid = g.general AND p.resource = s.resource""",
    "association_source": 'SELECT resource, association, source_end AS "sourceEnd" FROM {oriented}',
    "association_target": 'SELECT resource, association, target_end AS "targetEnd" FROM {oriented}',
    "association_ends": """SELECT resource, source_end AS uuid, source_name AS name, 'source' AS role FROM {oriented}
UNION ALL SELECT resource, target_end, target_name,
  CASE WHEN target_composite THEN 'targetComposite' ELSE 'targetReference' END FROM {oriented}""",
    "association_end_types": """SELECT resource, source_end AS "associationEnd", source_class AS type FROM {oriented}
UNION ALL SELECT resource, target_end, target_class FROM {oriented}""",
    "feature_lower_bounds": "SELECT resource, feature, lower FROM {bounded}",
    "feature_upper_bounds": "SELECT resource, feature, upper FROM {bounded}",
    "feature_ordering": 'SELECT resource, feature, "isOrdered" FROM {bounded}',
    "feature_bounds": "SELECT * FROM {bounded}",
    "attributes": "SELECT resource, uuid, name FROM {class_attr}",
    "attribute_types": "SELECT resource, uuid AS attribute, type FROM {class_attr}",
    "feature_type_uuid": """SELECT f.resource, f.uuid AS feature, f.type, t.type_kind,
  CASE WHEN t.type_kind IN ('class', 'stereotype') THEN 'class' ELSE 'datatype' END AS "typeRole"
FROM {raw_feature} f JOIN {raw_type} t ON t.uuid = f.type""",
    "feature_type_errors": """SELECT f.resource, f.uuid AS element, 'error' AS severity, 'feature-without-type' AS code,
  'Feature without a known type: ' || f.uuid AS message
FROM {raw_feature} f LEFT JOIN {raw_type} t ON t.uuid = f.type WHERE t.uuid IS NULL""",
    # ------------------------------------------------------------ lookups
    "taxonomy": "SELECT * FROM {taxa}",
    "specializations": """SELECT supertype AS metaclass, supertype_name AS metaclass_name, metaclass AS subtype,
  metaclass_name AS subtype_name, depth FROM {taxa}""",
    "effective_attributes":
        "SELECT metaclass, metaclass_name, attribute, name, type, kind, is_ordered, owner FROM {effective}",
    "concrete_metaclass_lookup":
        "SELECT uuid AS metaclass, name AS metaclass_name FROM {m_class} WHERE NOT is_abstract",
    "association_views": "SELECT * FROM {views}",
    "association_view_match": """SELECT holder, association, feature, feature_name, opposite, opposite_name,
  source_class, target_class, is_ordered FROM {matched}""",
    "redefinition_override": """SELECT metaclass, key, association, feature, feature_name, opposite, opposite_name,
  source_class, target_class, is_ordered FROM {cf} WHERE contains(feature_name, '__from_')""",
    "ambiguous_reverse_keys": """
SELECT x.metaclass, m.feature_name AS key, count(*) AS candidates, 'composite' AS kind
FROM {taxa} x JOIN {matched} m ON m.target_class = x.supertype WHERE m.contains GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT x.metaclass, m.feature_name, count(*), 'reference'
FROM {taxa} x JOIN {matched} m ON m.target_class = x.supertype WHERE m.refers GROUP BY 1, 2 HAVING count(*) > 1""",
    "association_pair_counts": """
SELECT 'composite' AS kind, count(*) AS pairs FROM (SELECT DISTINCT association, feature, opposite FROM {cf}) AS a
UNION ALL SELECT 'reference', count(*) FROM (SELECT DISTINCT association, feature, opposite FROM {rf}) AS b""",
    "lookup_forward_property": """SELECT metaclass, key AS property, association, feature_name
FROM (SELECT *, row_number() OVER (PARTITION BY metaclass, key ORDER BY rank) AS r FROM {forward}) AS f
WHERE r = 1""",
    "lookup_inverse_property": """SELECT metaclass, key AS property, association, feature_name
FROM (SELECT *, row_number() OVER (PARTITION BY metaclass, key ORDER BY rank, depth, association) AS r
  FROM {inverse}) AS f WHERE r = 1""",
    # ------------------------------------------------------------ profiles
    "stereotypes": f"""SELECT resource, uuid, name, is_abstract AS "isAbstract" FROM {{raw_stereotype}}
WHERE {_KIND_DOC.format("Profile")}""",
    "stereotype_extends": """SELECT p.resource, p.owner AS "extendingStereotype", c.uuid AS "extendedMetaclass"
FROM {stereo_prop} p JOIN {b_class} c ON c.name = p.type_name WHERE p.is_extension_end""",
    "stereotype_extends_errors": """SELECT p.resource, p.uuid AS element, 'error' AS severity,
  'base-property' AS code, CASE WHEN p.type IS NULL THEN 'Base property without a metaclass: ' || p.uuid
    ELSE 'Base property ' || p.uuid || ' refers to an unknown metaclass: ' || p.type_name END AS message
FROM {stereo_prop} p LEFT JOIN {b_class} c ON c.name = p.type_name WHERE p.is_extension_end AND c.uuid IS NULL""",
    "stereotype_attributes":
        "SELECT resource, owner AS stereotype, uuid AS attribute, idx AS index FROM {stereo_attr}",
    "stereotype_metaclass_props": """SELECT resource, owner AS "sourceStereotype", uuid AS "associationTargetEnd",
  target AS "targetMetaClass" FROM {class_prop} WHERE target IS NOT NULL""",
    "stereotype_metaclass_prop_errors": """SELECT resource, uuid AS element, 'fatal' AS severity,
  'property-metaclass' AS code,
  'Property ' || uuid || ' must be typed by a known metaclass: ' || type_name AS message
FROM {class_prop} WHERE target IS NULL""",
    "stereotype_stereotype_props": """SELECT resource, owner AS "sourceStereotype", uuid AS "associationTargetEnd",
  type AS "targetStereotype" FROM {stereo_stereo}""",
    "stereotype_generalizations": """SELECT s.resource, g.specific, g.general FROM {raw_generalization} g
JOIN {stereo} s ON s.uuid = g.specific JOIN {raw_stereotype} p ON p.uuid = g.general""",
    "extended_metamodels": f"""SELECT resource, '{METAMODEL}' AS "extendedMetamodel" FROM {{raw_document}}
WHERE kind = 'Profile'""",
    "profile_association_ends": """SELECT resource, uuid, name,
  CASE WHEN is_composite THEN 'targetComposite' ELSE 'targetReference' END AS role FROM {profile_end}""",
    # ------------------------------------------------------------ models
    "model_elements": """SELECT e.resource, e.uuid, c.uuid AS "metaClass"
FROM {model_element} e JOIN {b_class} c ON c.name = e.kind""",
    "model_element_errors": "SELECT * FROM {element_error}",
    "element_tool_ids": f"""SELECT resource, uuid, '{TOOL_VENDOR}' AS "toolVendorID", tool_id AS "toolElementID"
FROM {{model_element}}""",
    "element_tool_urls": f"""SELECT resource, uuid, '{TOOL_VENDOR}' AS "toolVendorID", tool_url AS "toolElementURL"
FROM {{model_element}}""",
    "instantiated_metamodels": f"""SELECT '{METAMODEL}' AS "instantiatedMetamodel", resource AS "instantiatingModel"
FROM {{raw_document}} WHERE kind = 'Model'""",
    "applied_profiles": """SELECT a.resource AS "applyingResource", a.applying_package AS "applyingPackage",
  d.resource AS "appliedResource", a.applied_profile AS "appliedProfile"
FROM {raw_profile_application} a JOIN {raw_document} d ON d.scope_package = a.applied_profile
WHERE a.applying_package IS NOT NULL""",
    "application_counts": "SELECT * FROM {app_count}",
    "stereotypes_by_profile": "SELECT * FROM {raw_application} WHERE profile IS NOT NULL",
    "stereotypes_by_profile_errors":
        "SELECT * FROM {application_error} WHERE code = 'stereotype-without-profile'",
    "resolve_profile": "SELECT resource, profile, profile_resource FROM {profile_use} WHERE exported IS NOT NULL",
    "resolve_profile_errors": "SELECT * FROM {application_error} WHERE code LIKE 'profile-%'",
    "applied_stereotypes": """SELECT resource, element AS "modelElement", stereotype AS "appliedStereotype"
FROM {application} WHERE known IS NOT NULL""",
    "append_errors": "SELECT * FROM {application_error}",
    "errors_by_element": """
SELECT element, CAST(floor(place / 1000) AS INT) AS block,
  string_agg(coalesce(message, 'null'), chr(10) ORDER BY place) AS messages, count(*) AS n_messages,
  CAST(sum(count(*)) OVER (PARTITION BY element) AS BIGINT) AS n_of_element,
  CAST(sum(count(*)) OVER () AS BIGINT) AS n_of_all
FROM (SELECT element, message, row_number() OVER (PARTITION BY element
    ORDER BY code NULLS FIRST, message NULLS FIRST, resource NULLS FIRST, severity) - 1 AS place
  FROM (SELECT DISTINCT resource, coalesce(element, 'model') AS element, severity, code, message FROM {every_error}) AS d
  ) AS p
GROUP BY 1, 2""",
    "error_totals": """SELECT severity, code, count(*) AS n FROM (
  SELECT DISTINCT resource, element, severity, code, message FROM {every_error}) AS e GROUP BY 1, 2""",
    "missing_dependency_paths": """SELECT missing, depth, path FROM {walk}
WHERE node NOT IN (SELECT node FROM {dep_via})""",
    "generalization_cycles": """SELECT 'urn:parts' AS resource, component AS element, 'fatal' AS severity,
  'cyclic-generalization' AS code,
  'Classes generalize each other: ' || CAST(count(*) AS STRING) || ' from ' || component AS message
FROM {part_cycle} GROUP BY component""",
    "ambiguous_features": """SELECT c.resource, m.metaclass AS element, 'error' AS severity, 'ambiguous-feature' AS code,
  CAST(m.n AS STRING) || ' unrelated classes give the feature ' || m.key || ', among them ' || m.first AS message
FROM (SELECT metaclass, key, count(DISTINCT holder) AS n, min(holder) AS first FROM {minimal} GROUP BY 1, 2) m
JOIN {m_class} c ON c.uuid = m.metaclass WHERE m.n > 1""",
    # ------------------------------------------------------------ values, tags, links
    "ordered_atomic_values": """SELECT resource, entity, attribute, value, idx AS index FROM {value_row}
WHERE kind = 'atomic' AND is_ordered""",
    "ordered_literal_values": """SELECT resource, entity, attribute, value, idx AS index FROM {value_row}
WHERE kind = 'enumeration' AND is_ordered AND value_kind = 'literal'""",
    "ordered_structured_values": """SELECT resource, entity, attribute, ref_instance AS value, idx AS index
FROM {value_row} WHERE kind = 'structured' AND is_ordered AND ref_instance IS NOT NULL""",
    "unordered_atomic_values": """SELECT resource, entity, attribute, value FROM {value_row}
WHERE kind = 'atomic' AND NOT is_ordered""",
    "unordered_literal_values": """SELECT resource, entity, attribute, value FROM {value_row}
WHERE kind = 'enumeration' AND NOT is_ordered AND value_kind = 'literal'""",
    "unordered_structured_values": """SELECT resource, entity, attribute, ref_instance AS value
FROM {value_row} WHERE kind = 'structured' AND NOT is_ordered AND ref_instance IS NOT NULL""",
    "ordered_atomic_tags": """SELECT resource, entity, feature AS attribute, value, position AS index FROM {tag_row}
WHERE type_kind = 'primitive' AND is_ordered""",
    "ordered_literal_tags": """SELECT resource, entity, feature AS attribute, value, position AS index FROM {tag_row}
WHERE type_kind = 'enumeration' AND is_ordered AND value_kind = 'literal'""",
    "ordered_structured_tags": "SELECT * FROM {tag_error}",
    "ordered_stereotype_refs": """SELECT resource, entity AS "modelElement", feature AS "associationTargetEnd",
  target AS "referencedElement", position AS index FROM {tag_ref} WHERE is_ordered AND target IS NOT NULL""",
    "unordered_stereotype_refs": """SELECT resource, entity AS "modelElement", feature AS "associationTargetEnd",
  target AS "referencedElement" FROM {tag_ref} WHERE NOT is_ordered AND target IS NOT NULL""",
    "unordered_stereotype_ref_errors": """SELECT resource, element, severity, code, message FROM {tag_ref_error}
WHERE NOT is_ordered""",
    "rebuild_slots": """SELECT resource, entity, attribute, CAST(floor(idx / 10000) AS INT) AS block,
  string_agg(value, ',' ORDER BY idx) AS values
FROM {value_row} WHERE kind = 'atomic' AND is_ordered GROUP BY 1, 2, 3, 4""",
    "typed_values": """SELECT v.resource, v.entity, v.attribute, v.value, m.xsd AS "datatypeMapDefinition",
  CASE WHEN m.xsd = 'xsd:boolean' THEN TRY_CAST(v.value AS BOOLEAN) END AS "booleanValue",
  CASE WHEN m.xsd = 'xsd:integer' THEN TRY_CAST(v.value AS BIGINT) END AS "integerValue",
  CASE WHEN m.xsd = 'xsd:double' THEN TRY_CAST(v.value AS DOUBLE) END AS "doubleValue",
  CASE WHEN m.xsd = 'xsd:string' THEN v.value END AS "stringValue"
FROM {value_row} v JOIN {class_attr} a ON a.uuid = v.attribute JOIN {raw_type} t ON t.uuid = a.type
JOIN {primitive_map} m ON m.name = t.name WHERE v.kind = 'atomic'""",
    "ordered_links": """SELECT resource, entity AS "sourceElement", ref AS "targetElement",
  association AS "metaAssociation", position AS index FROM {link_row}
WHERE is_ordered AND is_collection AND value_kind = 'element'""",
    "unordered_links": """SELECT resource, entity AS "sourceElement", ref AS "targetElement",
  association AS "metaAssociation" FROM {link_row}
WHERE NOT is_ordered AND is_collection AND value_kind = 'element'""",
    "unordered_links_single_valued": """SELECT resource, entity AS "sourceElement", ref AS "targetElement",
  association AS "metaAssociation" FROM {link_row} WHERE NOT is_ordered AND value_kind = 'element'""",
    "link_errors": "SELECT * FROM {link_error}",
    "links_per_association": """SELECT l.resource, v.name AS "associationName", count(*) AS n_links,
  max(l.position) AS last_index
FROM {link_row} l JOIN {views} v ON v.association = l.association
WHERE l.is_ordered AND l.is_collection AND l.value_kind = 'element' GROUP BY 1, 2""",
    # ------------------------------------------------------------ change events
    "relevant_changes": "SELECT txn, seq, entity, property FROM {relevant}",
    "route_change": "SELECT txn, seq, entity, property, route, association FROM {routed}",
    "change_kind": 'SELECT txn, seq, kind AS "changeKind", value FROM {kind_value}',
    "change_description": "SELECT txn, seq, description FROM {routed}",
    "element_added": """SELECT txn, seq, "changeKind", resource, uuid, "metaClass" FROM {element_change}
WHERE "changeKind" = 'AddedChange'""",
    "element_deleted": """SELECT txn, seq, "changeKind", resource, uuid, "metaClass" FROM {element_change}
WHERE "changeKind" = 'DeletedChange'""",
    "unknown_element_log": """SELECT txn, seq, entity, route, description FROM {routed}
WHERE route IN ('created', 'deleted') AND metaclass NOT IN (SELECT name FROM {b_class} WHERE NOT is_abstract)""",
    "pre_delete_log": "SELECT txn, seq, entity, description FROM {routed} WHERE route = 'before delete'",
    "forward_link_changes": """SELECT txn, seq, entity, property, association, "linkChange", path FROM {link_change}
WHERE route = 'forward'""",
    "inverse_link_changes": """SELECT txn, seq, entity, property, association, "linkChange", path FROM {link_change}
WHERE route = 'inverse'""",
    "classify_changes": "SELECT * FROM {record}",
    "classify_changes_stream": "SELECT * FROM {record}",
    "classify_changes_filled": """SELECT r.txn, r.seq, r.event, coalesce(e.resource, r.resource) AS resource, r.entity
FROM {record} r LEFT JOIN {raw_element} e ON e.uuid = r.entity""",
    "write_change_events": """SELECT txn, seq, description ||
  CASE WHEN event = 'ModelElementChangedEvent' AND "changeKind" = 'DeletedChange'
    THEN chr(10) || 'post(DELETE) UUID=' || entity ELSE '' END AS messages, event, "changeKind" FROM {record}""",
    "read_changes": "SELECT * FROM {raw_change}",
}

STATEMENTS["classify_split_commits"] = STATEMENTS["notified_records"] = STATEMENTS["classify_changes"]
STATEMENTS["sorted_by_name"] = """SELECT resource, uuid, name, is_abstract AS "isAbstract",
  CAST(row_number() OVER (ORDER BY name NULLS FIRST, uuid) - 1 AS INT) AS place FROM {m_class}"""
STATEMENTS["document_set_round_trip"] = STATEMENTS["document_config_rows"]
STATEMENTS["read_document_sets"] = f"""
SELECT "set", CAST(row_number() OVER (PARTITION BY "set" ORDER BY "packageURI", "toolSpecificPackageID") - 1 AS INT)
  AS place, "packageURI", "artifactKind", "toolSpecificPackageID"
FROM (SELECT *, CASE "artifactKind" WHEN 'LibraryArtifact' THEN 0 WHEN 'ProfileArtifact' THEN 1 ELSE 2 END AS "set"
  FROM ({STATEMENTS["document_config_rows"]}) AS c
  WHERE "artifactKind" IN ('LibraryArtifact', 'ProfileArtifact', 'MetamodelArtifact')) AS d"""


def _imports(kind: str, condition: str = "true") -> str:
    return f"""SELECT o.resource AS importing, d.resource AS imported
FROM {{raw_import}} i JOIN {{raw_document}} o ON o.scope_package = i.importer AND o.kind = '{kind}'
JOIN {{raw_document}} d ON d.scope_package = i.imported WHERE {condition}"""


STATEMENTS["library_imports"] = _imports("Library")
STATEMENTS["metamodel_imports"] = _imports("Metamodel", "d.kind = 'Metamodel'")
STATEMENTS["metamodel_library_imports"] = _imports("Metamodel", "d.kind = 'Library'")
STATEMENTS["profile_imports"] = _imports("Profile", "i.imported_kind = 'Profile'")



def _import_warnings(kind: str, condition: str = "true") -> str:
    return f"""SELECT o.resource, i.importer AS element, 'warning' AS severity, 'import-without-document' AS code,
  i.importer || ' imports a package without a known document: ' || i.imported AS message
FROM {{raw_import}} i JOIN {{raw_document}} o ON o.scope_package = i.importer AND o.kind = '{kind}'
LEFT JOIN {{raw_document}} d ON d.scope_package = i.imported WHERE d.resource IS NULL AND {condition}"""


# step -> its errors, in the order of the steps
_ERROR_STEPS = {
    "Library imports": _import_warnings("Library"),
    "Metamodel imports": _import_warnings("Metamodel"),
    "Profile imports": _import_warnings("Profile", "i.imported_kind = 'Profile'"),
    "applied stereotypes": "SELECT * FROM {application_error}",
    "elements": "SELECT * FROM {element_error}",
    "document packages": "SELECT * FROM {package_error}",
    "references": "SELECT resource, element, severity, code, message FROM {tag_ref_error}",
    "structured tags": "SELECT * FROM {tag_error}",
    "links": "SELECT * FROM {link_error}",
    "extended metaclasses": STATEMENTS["stereotype_extends_errors"],
    "metaclass properties": STATEMENTS["stereotype_metaclass_prop_errors"],
}
CHECKS["every_error"] = " UNION ALL ".join(f"SELECT * FROM ({e}) AS e" for e in _ERROR_STEPS.values())
_placed = " UNION ALL ".join(
    f"SELECT resource, element, severity, code, message, {place} AS place, '{step}' AS step FROM ({errors}) AS e"
    for place, (step, errors) in enumerate(_ERROR_STEPS.items())
)
STATEMENTS["errors_by_step"] = f"""SELECT step, severity, count(*) AS n FROM (
  SELECT severity, arg_min(step, place) AS step FROM ({_placed}) AS p GROUP BY resource, element, severity, code, message
) AS e GROUP BY 1, 2"""

# step of the export chain -> (its rows, its errors)
_GATES = {
    "elements": (STATEMENTS["model_elements"], "SELECT * FROM {element_error}"),
    "applied stereotypes": (STATEMENTS["applied_stereotypes"], "SELECT * FROM {application_error}"),
    "links": (STATEMENTS["ordered_links"], "SELECT * FROM {link_error}"),
    "references": (STATEMENTS["unordered_stereotype_refs"], STATEMENTS["unordered_stereotype_ref_errors"]),
}
_open = "SELECT DISTINCT resource FROM {model_element} WHERE resource IS NOT NULL"
for _place, (_rows, _errors) in enumerate(_GATES.values()):
    CHECKS[f"gate_{_place}"] = f"""SELECT o.resource, coalesce(r.n, 0) AS n_rows, coalesce(e.n, 0) AS n_errors,
  CASE WHEN e.n IS NULL THEN 'done' WHEN r.n IS NULL THEN 'stopped' ELSE 'partial' END AS outcome
FROM ({_open}) AS o LEFT JOIN (SELECT resource, count(*) AS n FROM ({_rows}) AS x GROUP BY 1) r ON r.resource = o.resource
LEFT JOIN (SELECT resource, count(*) AS n FROM ({_errors}) AS x WHERE severity <> 'warning' GROUP BY 1) e
  ON e.resource = o.resource"""
    _open = f"SELECT resource FROM {{gate_{_place}}} WHERE outcome <> 'stopped'"
STATEMENTS["export_gates"] = " UNION ALL ".join(
    f"SELECT resource, {place} AS place, '{step}' AS step, n_rows, n_errors, outcome FROM {{gate_{place}}}"
    for place, step in enumerate(_GATES)
)

for (_source, _target), (_s, _t) in RESTRICTIONS.items():
    STATEMENTS[f"assoc_gen_{_source[:-1]}_{_target[:-1]}"] = f"""SELECT * FROM {{assoc_gen}}
WHERE "sourceRestriction" = {str(_s).lower()} AND "targetRestriction" = {str(_t).lower()}"""

for _kind in KINDS:
    STATEMENTS[f"{_kind}_attributes"] = f"""SELECT resource, owner, uuid, name, type, idx AS index, is_ordered
FROM {{class_attr}} WHERE kind = '{_kind}'"""
    for _word, _flag in (("ordered", "true"), ("unordered", "false")):
        STATEMENTS[f"metaclass2{_word}_{_kind}_attribute"] = f"""SELECT resource, owner AS "metaClass",
  uuid AS attribute, idx AS index FROM {{class_attr}} WHERE kind = '{_kind}' AND is_ordered = {_flag}"""
        if _kind == "structured":
            continue
        STATEMENTS[f"attr_lookup_{_word}_{_kind}"] = f"""SELECT metaclass, metaclass_name, name, attribute,
  implementation, implementation_ordered FROM {{attr_lookup}} WHERE kind = '{_kind}' AND is_ordered = {_flag}"""

for _name, _cte in (("containment_forward", "cf"), ("containment_reverse", "cr"),
                    ("reference_forward", "rf"), ("reference_reverse", "rr")):
    STATEMENTS[_name] = f"""SELECT metaclass, key, association, feature, feature_name, opposite, opposite_name,
  source_class, target_class, is_ordered FROM {{{_cte}}}"""

for (_kind, _ordered), _event in VALUE_EVENTS.items():
    _word = f"{'ordered' if _ordered else 'unordered'}_{'atomic' if _kind == 'atomic' else 'literal'}"
    STATEMENTS[f"{_word}_changes"] = f"""SELECT txn, seq, "changeKind", resource, entity, attribute, value
  {', index' if _ordered else ''} FROM {{value_change}} WHERE kind = '{_kind}' AND is_ordered = {str(_ordered).lower()}"""

# Tables of each bundle: the statement that gives its rows, with the table's own column names.


def _named(statement: str, **columns: str) -> str:
    return f"SELECT {', '.join(f'{c} AS \"{n}\"' for n, c in columns.items())} FROM ({statement}) AS x"


def _of_models(statement: str) -> str:
    """The rows of the selected models."""
    return f"SELECT * FROM ({statement}) AS x WHERE resource IN (SELECT resource FROM {{selected_doc}} WHERE kind = 'Model')"


def _resources(kind: str, documents: str = "raw_document") -> str:
    return f"SELECT resource, kind FROM {{{documents}}} WHERE kind = '{kind}'"


_STEREO_BOUND = """SELECT resource, uuid AS feature, lower, upper, is_ordered AS "isOrdered" FROM (
  SELECT resource, uuid, lower, upper, is_ordered FROM {stereo_attr}
  UNION ALL SELECT resource, uuid, lower, upper, is_ordered FROM {profile_end}) AS e"""

_BUNDLES = {
    "export_library": {
        "resources": _resources("Library"),
        "importedLibraries":
            _named(STATEMENTS["library_imports"], importingResource="importing", importedLibrary="imported"),
        "primitiveDataTypes": STATEMENTS["primitive_types"],
        "enumerationDataTypes": STATEMENTS["enumeration_types"],
        "enumeration2literals": STATEMENTS["enumeration_literals_indexed"],
        "enumerationLiterals": STATEMENTS["enumeration_literal_names"],
        "errors": f"{STATEMENTS['primitive_type_errors']} UNION ALL {STATEMENTS['library_import_warnings']}",
    },
    "export_metamodel": {
        "resources": _resources("Metamodel"),
        "importedMetamodels":
            _named(STATEMENTS["metamodel_imports"], importingMetamodel="importing", importedMetamodel="imported"),
        "importedLibraries":
            _named(STATEMENTS["metamodel_library_imports"], importingResource="importing", importedLibrary="imported"),
        **{
            t: STATEMENTS[q] for t, q in {
                "metaClasses": "meta_classes", "metaClassGeneralizations": "metaclass_generalizations",
                "metaAssociations": "meta_associations", "metaAssociationGeneralizations": "assoc_generalizations",
                "metaAssociation2Source": "association_source", "metaAssociation2Target": "association_target",
                "metaAssociationEnds": "association_ends", "metaAssociationEnd2MetaClass": "association_end_types",
                "attributes": "attributes", "attribute2type": "attribute_types",
                "featureLowerBounds": "feature_lower_bounds", "featureUpperBounds": "feature_upper_bounds",
                "featureOrdering": "feature_ordering",
                **{
                    f"metaClass2{w}{k.capitalize()}Attribute": f"metaclass2{w}_{k}_attribute"
                    for k in KINDS for w in ("ordered", "unordered")
                },
            }.items()
        },
    },
    "export_profile": {
        "resources": _resources("Profile", "selected_doc"),
        "extendedMetamodels": f"""SELECT resource, '{METAMODEL}' AS "extendedMetamodel" FROM {{selected_doc}}
WHERE kind = 'Profile'""",
        "importedProfiles": """SELECT o.resource AS "importingProfile", d.resource AS "importedProfile"
FROM {raw_import} i JOIN {selected_doc} o ON o.scope_package = i.importer AND o.kind = 'Profile'
JOIN {selected_doc} d ON d.scope_package = i.imported WHERE i.imported_kind = 'Profile'""",
        "stereotypes": 'SELECT resource, uuid, name, is_abstract AS "isAbstract" FROM {stereo}',
        "attributes": "SELECT resource, uuid, name FROM {stereo_attr}",
        "attribute2type": "SELECT resource, uuid AS attribute, library_type AS type FROM {stereo_attr}",
        "featureLowerBounds": f"SELECT resource, feature, lower FROM ({_STEREO_BOUND}) AS b",
        "featureUpperBounds": f"SELECT resource, feature, upper FROM ({_STEREO_BOUND}) AS b",
        "featureOrdering": f'SELECT resource, feature, "isOrdered" FROM ({_STEREO_BOUND}) AS b',
        **{
            t: STATEMENTS[q] for t, q in {
                "generalizations": "stereotype_generalizations", "extendedMetaclasses": "stereotype_extends",
                "stereotypeAttributes": "stereotype_attributes",
                "stereotype2MetaClassProperty": "stereotype_metaclass_props",
                "stereotype2StereotypeProperty": "stereotype_stereotype_props",
                "associationTargetEnds": "profile_association_ends",
            }.items()
        },
        "errors": f"""{STATEMENTS['stereotype_extends_errors']}
UNION ALL {STATEMENTS['stereotype_metaclass_prop_errors']}
UNION ALL SELECT o.resource, i.importer, 'warning', 'import-without-document',
  i.importer || ' imports a package without a known document: ' || i.imported
FROM {{raw_import}} i JOIN {{selected_doc}} o ON o.scope_package = i.importer AND o.kind = 'Profile'
WHERE i.imported_kind = 'Profile' AND i.imported NOT IN (SELECT scope_package FROM {{selected_doc}})""",
    },
    "export_model": {
        "resources": _resources("Model", "selected_doc"),
        "instantiatedMetamodels": f"""SELECT '{METAMODEL}' AS "instantiatedMetamodel",
  resource AS "instantiatingModel" FROM {{selected_doc}} WHERE kind = 'Model'""",
        "appliedProfiles": """SELECT a.resource AS "applyingResource", a.applying_package AS "applyingPackage",
  d.resource AS "appliedResource", a.applied_profile AS "appliedProfile"
FROM {raw_profile_application} a JOIN {selected_doc} d ON d.scope_package = a.applied_profile
JOIN {selected_doc} o ON o.resource = a.resource AND o.kind = 'Model' WHERE a.applying_package IS NOT NULL""",
        **{
            t: _of_models(STATEMENTS[q]) for t, q in {
                "elements": "model_elements", "elementIDs": "element_tool_ids", "elementURLs": "element_tool_urls",
                "orderedAtomicValues": "ordered_atomic_values", "orderedLiteralValues": "ordered_literal_values",
                "orderedStructuredValues": "ordered_structured_values",
                "unorderedAtomicValues": "unordered_atomic_values",
                "unorderedLiteralValues": "unordered_literal_values",
                "unorderedStructuredValues": "unordered_structured_values",
                "appliedStereotypes": "applied_stereotypes", "orderedStereotypeReferences": "ordered_stereotype_refs",
                "unorderedStereotypeReferences": "unordered_stereotype_refs", "orderedLinks": "ordered_links",
                "unorderedLinks": "unordered_links",
            }.items()
        },
        # A model export sees the selected documents only: profiles left out of it have no document there.
        "errors": _of_models("""SELECT * FROM {element_error} UNION ALL SELECT * FROM {link_error}
UNION ALL SELECT * FROM {tag_error} UNION ALL SELECT resource, element, severity, code, message FROM {tag_ref_error}
UNION ALL SELECT * FROM {application_error} WHERE code NOT LIKE 'profile-%'
UNION ALL SELECT resource, profile, 'error', 'profile-without-document', 'No document for profile ' || profile
FROM {profile_use} WHERE exported IS NULL""") + " UNION ALL " + STATEMENTS["export_per_document_errors"],
    },
}
_FAMILY = {"export_library": "Library", "export_metamodel": "Metamodel", "export_profile": "Profile", "export_model": "Model"}


def _contents(bundle: str, errors: bool = True) -> list[str]:
    """Per table the rows and the sum of the first 60 bits of each row text's hash; an empty table gives no row."""
    out = []
    for table, statement in _BUNDLES[bundle].items():
        if table == "errors" and not errors:
            continue
        ddl = ERRORS if table == "errors" else FAMILIES[_FAMILY[bundle]][table]
        columns = sorted(field.split()[0] for field in ddl.split(","))
        text = " || ".join(
            f"coalesce(strlen(CAST(\"{c}\" AS STRING)) || ':' || CAST(\"{c}\" AS STRING), '-')" for c in columns
        )
        number = f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"
        out.append(f"""SELECT '{table}' AS "table", count(*) AS n_rows, CAST(sum({number}) AS STRING) AS content
FROM ({statement}) AS x HAVING count(*) > 0""")
    return out


for _name in _BUNDLES:
    STATEMENTS[_name] = "\nUNION ALL ".join(_contents(_name))
STATEMENTS["library_round_trip"] = STATEMENTS["export_library"]
STATEMENTS["metamodel_round_trip"] = STATEMENTS["export_metamodel"]
STATEMENTS["profiles_and_models_round_trip"] = "\nUNION ALL ".join(
    f"SELECT *, '{_FAMILY[bundle]}' AS family FROM ({sql}) AS y"
    for bundle in ("export_profile", "export_model") for sql in _contents(bundle, errors=False)
)


_COLLECTED = {"AtomicValues": "atomic_values", "LiteralValues": "literal_values", "StructuredValues": "structured_values",
              "Links": "links"}
STATEMENTS["rebuild_all_slots"] = """SELECT "table", resource, entity, attribute,
  CAST(floor(i / 10000) AS INT) AS block, string_agg(coalesce(value, 'null'), ',' ORDER BY i) AS values
FROM (""" + "\nUNION ALL ".join(
    f"SELECT '{word}{t}' AS \"table\", resource, {columns}, "
    + ("index" if word == "ordered" else f"row_number() OVER (PARTITION BY resource, {key} ORDER BY {value} NULLS FIRST) - 1")
    + f" AS i FROM ({STATEMENTS[f'{word}_{q}']}) AS x"
    for word in ("ordered", "unordered") for t, q in _COLLECTED.items()
    for key, value in [('"sourceElement", "metaAssociation"', '"targetElement"') if t == "Links"
                       else ("entity, attribute", "value")]
    for columns in ['"sourceElement" AS entity, "metaAssociation" AS attribute, "targetElement" AS value'
                    if t == "Links" else "entity, attribute, value"]
) + ") AS s GROUP BY 1, 2, 3, 4, 5"


_SLOT_COLUMNS = {"Links": '"sourceElement" AS entity, "metaAssociation" AS attribute'}
_FOUND = " UNION ALL ".join(
    f"SELECT '{word}{t}' AS \"table\", resource, {_SLOT_COLUMNS.get(t, 'entity, attribute')} FROM ({STATEMENTS[f'{word}_{q}']}) AS x"
    for word in ("ordered", "unordered") for t, q in _COLLECTED.items()
)
_EXPECTED = """SELECT CASE WHEN is_ordered THEN 'ordered' ELSE 'unordered' END || CASE kind WHEN 'atomic' THEN 'Atomic'
    WHEN 'enumeration' THEN 'Literal' ELSE 'Structured' END || 'Values' AS "table", resource, entity, attribute
  FROM {value_row} WHERE kind = 'atomic' OR (kind = 'enumeration' AND value_kind = 'literal')
    OR (kind = 'structured' AND ref_instance IS NOT NULL)
  UNION ALL SELECT CASE WHEN is_ordered THEN 'orderedLinks' ELSE 'unorderedLinks' END, resource, entity, association
  FROM {link_row} WHERE is_collection AND value_kind = 'element'"""
_KEYS = '"table", resource, entity, attribute'
STATEMENTS["lost_values"] = f"""SELECT {_KEYS}, coalesce(e.n, 0) AS n_expected, coalesce(f.n, 0) AS n_found
FROM (SELECT {_KEYS}, count(*) AS n FROM ({_EXPECTED}) AS x GROUP BY ALL) e
FULL JOIN (SELECT {_KEYS}, count(*) AS n FROM ({_FOUND}) AS x GROUP BY ALL) f USING ({_KEYS})
WHERE e.n IS DISTINCT FROM f.n"""
STATEMENTS["lost_values_planted"] = f"""SELECT 'orderedAtomicValues' AS "table", resource, entity, attribute,
  count(*) AS n_expected, count(*) FILTER (WHERE index <> 2) AS n_found
FROM ({STATEMENTS["ordered_atomic_values"]}) AS x GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (WHERE index = 2) > 0"""


def _unresolved(table: str, column: str, universe: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", "{column}" AS reference, count(*) AS n_rows
FROM ({_BUNDLES["export_model"][table]}) AS x WHERE "{column}" NOT IN (SELECT uuid FROM {universe}) GROUP BY 3"""


STATEMENTS["unresolved_references"] = "\nUNION ALL ".join([
    _unresolved("elements", "metaClass", "{b_class}"),
    *[_unresolved(t, "attribute", "{class_attr}") for t in (
        "orderedAtomicValues", "unorderedAtomicValues", "orderedLiteralValues", "unorderedLiteralValues",
        "orderedStructuredValues", "unorderedStructuredValues")],
    *[_unresolved(t, "value", "{raw_literal}") for t in ("orderedLiteralValues", "unorderedLiteralValues")],
    *[_unresolved(t, "value", "{model_element}") for t in ("orderedStructuredValues", "unorderedStructuredValues")],
    *[_unresolved(t, c, u) for t in ("orderedLinks", "unorderedLinks")
      for c, u in (("sourceElement", "{model_element}"), ("targetElement", "{model_element}"),
                   ("metaAssociation", "(SELECT association AS uuid FROM {views})"))],
    _unresolved("appliedStereotypes", "modelElement", "{model_element}"),
    _unresolved("appliedStereotypes", "appliedStereotype", "{stereo}"),
    _unresolved("appliedProfiles", "appliedProfile", "(SELECT scope_package AS uuid FROM {raw_document})"),
    *[_unresolved(t, "associationTargetEnd", "{raw_feature}") for t in (
        "orderedStereotypeReferences", "unorderedStereotypeReferences")],
    *[_unresolved(t, c, "{model_element}") for t in (
        "orderedStereotypeReferences", "unorderedStereotypeReferences") for c in ("modelElement", "referencedElement")],
])

# ---------------------------------------------------------------- whole statements

_CTES = BASE | CHANGES | CHECKS


def _uses(sql: str) -> list[str]:
    return [field for _, field, _, _ in string.Formatter().parse(sql) if field]


def _with(statement: str) -> str:
    """The statement with the named SQL it needs, each before its users."""
    ordered: dict[str, str] = {}

    def need(name: str) -> None:
        if name in ordered or name in STAR_TABLES:
            return
        if name in _RECURSIVE:
            text, before = _RECURSIVE[name]
            for other in before:
                need(other)
            ordered[name] = text
            return
        sql = _CTES[name]
        for other in _uses(sql):
            need(other)
        ordered[name] = f"{name} AS ({sql.format(**{u: u for u in _uses(sql)})})"

    for name in _uses(statement):
        need(name)
    body = statement.format(**{u: u for u in _uses(statement)}).strip()
    return f"WITH RECURSIVE {', '.join(ordered.values())}\n{body}" if ordered else body


def oracle() -> dict[str, str]:
    return {name: _with(sql) for name, sql in STATEMENTS.items()}
