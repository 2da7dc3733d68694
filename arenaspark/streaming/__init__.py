from arenaspark.streaming.contests import latest_team_table, running_team_table  # noqa: F401
