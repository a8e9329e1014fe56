"""The derived inputs of ``sources.derived`` written as SQL over the provided tables."""

CATALOG = """
select cast(p_partkey as varchar) as sample_id,
  case when p_partkey % 97 = 1 then null when p_partkey % 97 = 2 then ''
  else concat_ws(' ',
    case p_partkey % 5 when 0 then 'PREMIUM' when 1 then 'Deluxe' when 2 then 'budget' when 3 then 'Sale' else 'plain' end,
    p_name, lower(p_type),
    case p_partkey % 16
      when 0 then concat(cast(p_size as varchar), ' kg')      when 1 then concat(cast(p_size as varchar), 'g')
      when 2 then concat(cast(p_size as varchar), '.5 mg')    when 3 then concat(cast(p_size as varchar), ' l')
      when 4 then concat(cast(p_size as varchar), 'ml')       when 5 then concat(cast(p_size as varchar), ' meters')
      when 6 then concat(cast(p_size as varchar), ' cm')      when 7 then concat(cast(p_size as varchar), ' mm')
      when 8 then concat('pack of ', cast(p_size as varchar)) when 9 then concat(cast(p_size as varchar), ' pack')
      when 10 then concat(cast(p_size as varchar), ' count')  when 11 then concat(cast(p_size as varchar), ' pieces')
      when 12 then concat(cast(p_size as varchar), 'pcs')     when 13 then 'high-quality' else 'item' end)
  end as catalog_content,
  concat('http://img.example/', cast(p_partkey as varchar), '.jpg') as image_link,
  p_retailprice as price
from part
"""

DOCS = "select cast(doc_id as varchar) as sample_id, text as catalog_content from documents"

PREDICTIONS = """
select cast(o_orderkey as varchar) as sample_id, model, o_totalprice as y_true,
  o_totalprice * (1 + (((o_orderkey * 7919 + k * 104729) % 401) - 200) / cast(1000 as double)) as pred
from orders cross join (values ('neural_net', 1), ('lightgbm', 2), ('xgboost', 3), ('catboost', 4)) m(model, k)
"""

MANIFEST = """
select event_type as stage,
  case user_id % 3 when 0 then 'quick' when 1 then 'full' else 'minimal' end as checkpoint_type,
  event_id, ts, case when event_id % 4 = 0 then null else value end as metric
from events
"""


def with_fixtures(body: str) -> str:
    """Prefix a query with the fixture CTEs (catalog, docs, preds, manifest)."""
    return (f"with catalog as ({CATALOG}), docs as ({DOCS}), preds as ({PREDICTIONS}), "
            f"manifest as ({MANIFEST})\n{body}")
