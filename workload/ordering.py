"""Sort, limit and set operations."""

from __future__ import annotations

from millrace.operators import projects
from workload import inputs
from workload.joins import DATES_SQL
from workload.registered import query


@query("project_list", DATES_SQL + " SELECT * FROM list ORDER BY created_at DESC, project")
def project_list(spark, sf_dir):
    return projects.project_list(
        inputs.project_folders(spark, sf_dir), projects.project_dates(inputs.commits(spark, sf_dir))
    )


@query("last_commits", """
    SELECT 'prj_' || user_id AS project, ts, CASE event_type WHEN 'signup' THEN 'A' ELSE 'M' END AS kind,
           'commit-' || event_id AS commit_id
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, kind DESC, commit_id DESC) = 1""")
def last_commits(spark, sf_dir):
    return projects.last_commits(inputs.commits(spark, sf_dir))
