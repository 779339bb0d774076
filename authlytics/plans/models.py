"""The models wired together; each is planned only when asked for, and stays lazy."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from authlytics.operators import funnel, marts, sessions, staging


class Models:
    """Every model over two raw tables, given as functions that load them."""

    def __init__(self, load_users: Callable[[], DataFrame], load_events: Callable[[], DataFrame]):
        self._load_users = load_users
        self._load_events = load_events

    @cached_property
    def raw_users(self) -> DataFrame:
        return self._load_users()

    @cached_property
    def raw_auth_events(self) -> DataFrame:
        return self._load_events()

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw_users)

    @cached_property
    def stg_auth_events(self) -> DataFrame:
        return staging.stg_auth_events(self.raw_auth_events)

    @cached_property
    def int_user_sessions(self) -> DataFrame:
        return sessions.int_user_sessions(self.stg_auth_events)

    @cached_property
    def _sessions(self) -> DataFrame:
        """What the marts read of the sessions: not their last error code."""
        return sessions.sessions_without_codes(self.stg_auth_events)

    @cached_property
    def int_auth_funnel(self) -> DataFrame:
        return funnel.int_auth_funnel(self.stg_auth_events)

    @cached_property
    def daily_sessions(self) -> DataFrame:
        return marts.daily_sessions(self._sessions)

    @cached_property
    def daily_funnel(self) -> DataFrame:
        return marts.daily_funnel(self.int_auth_funnel)

    @cached_property
    def fct_daily_auth_metrics(self) -> DataFrame:
        return marts.fct_daily_auth_metrics(self.daily_sessions, self.daily_funnel)

    @cached_property
    def user_session_history(self) -> DataFrame:
        return marts.user_session_history(self._sessions)

    @cached_property
    def user_friction_scores(self) -> DataFrame:
        return marts.user_friction_scores(self.user_session_history, self.stg_users)
