"""Schemas of records, fragments, entries, relations, findings and revisions.

Attributes are maps of JSON texts, so that values of any type keep it. A citation is a struct of both of its forms: cited
rows have ``source``, uncited ones ``uncited``.
"""

CITATION = "struct<source:string,source_record_id:string,locator:string,url:string,uncited:boolean,reason:string>"
SNAPSHOT = "source string, key string, payload string"
RECORD = "source string, snapshot_key string, key string, payload string"
#: ord is the arrival order: (number of the source's binding, of the record, of the fragment).
ORD = "struct<binding:int,record:bigint,emit:int>"
ENTRY_FRAGMENT = f"source string, source_record_id string, provisional_id string, family string, kind string, name string, attributes map<string,string>, citations array<{CITATION}>, ord {ORD}"
RELATION_FRAGMENT = f"source string, source_record_id string, from_id string, relation_kind string, to_id string, citations array<{CITATION}>, ord {ORD}"
ENTRY = f"id string, family string, kind string, name string, attributes map<string,string>, citations array<{CITATION}>"
RELATION = f"from_id string, kind string, to_id string, citations array<{CITATION}>"
FINDING = f"kind string, code string, message string, citation {CITATION}"
REVISION = f"id string, source string, target_kind string, target_id string, target struct<canonical_id:string,previous_ids:array<string>,source_refs:array<{CITATION}>,kind:string,name:string>, rationale string, evidence array<{CITATION}>, patch string"
ALIAS = f"id string, canonical_id string, previous_ids array<string>, source_refs array<{CITATION}>, kind string, name string, rationale string, evidence array<{CITATION}>"
