"""Explicit schemas of the four raw tables, and the declared text lengths."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _D = T.StringType(), T.DateType()

RAW_LEADS = _struct(
    lead_id=_S, contact_name=_S, company_name=_S, industry=_S, company_size=_S, lead_source=_S,
    job_title=_S, country=_S, region=_S, status=_S, created_date=_D,
)
RAW_OPPORTUNITIES = _struct(
    opportunity_id=_S, lead_id=_S, deal_value=T.DoubleType(), stage=_S, owner=_S,
    open_date=_D, expected_close_date=_D, actual_close_date=_D,
)
RAW_ACTIVITIES = _struct(
    activity_id=_S, lead_id=_S, activity_date=_D, activity_type=_S, channel=_S, outcome=_S,
)
RAW_CAMPAIGN_TOUCHES = _struct(
    touch_id=_S, lead_id=_S, campaign_id=_S, touch_date=_D, response=_S, treatment_group=_S,
)

RAW_TABLES = {
    "raw_leads": RAW_LEADS,
    "raw_opportunities": RAW_OPPORTUNITIES,
    "raw_activities": RAW_ACTIVITIES,
    "raw_campaign_touches": RAW_CAMPAIGN_TOUCHES,
}

# Declared VARCHAR lengths of the raw and the cleaned tables.
TEXT_LIMITS = {
    "raw_leads": {
        "lead_id": 20, "contact_name": 150, "company_name": 150, "industry": 50, "company_size": 50,
        "lead_source": 50, "job_title": 100, "country": 100, "region": 50, "status": 50,
    },
    "raw_opportunities": {"opportunity_id": 20, "lead_id": 20, "stage": 50, "owner": 150},
    "raw_activities": {
        "activity_id": 20, "lead_id": 20, "activity_type": 50, "channel": 50, "outcome": 50,
    },
    "raw_campaign_touches": {
        "touch_id": 20, "lead_id": 20, "campaign_id": 20, "response": 50, "treatment_group": 20,
    },
    "leads_clean": {
        "lead_id": 20, "contact_name": 150, "company_name": 150, "industry": 50,
        "lead_source": 50, "job_title": 100, "country": 100, "region": 50, "status": 50,
    },
    "opportunities_clean": {"opportunity_id": 20, "lead_id": 20, "stage": 50, "owner": 150},
    "activities_clean": {
        "activity_id": 20, "lead_id": 20, "activity_type": 50, "channel": 50, "outcome": 50,
    },
    "activities_rejected": {
        "activity_id": 20, "lead_id": 20, "activity_type": 50, "channel": 50, "outcome": 50,
        "rejection_reason": 100,
    },
    "campaign_touches_clean": {
        "touch_id": 20, "lead_id": 20, "campaign_id": 20, "response": 50, "treatment_group": 20,
    },
}
