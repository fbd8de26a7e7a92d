"""Parameters of a triage run."""

from __future__ import annotations

from dataclasses import dataclass, field

from replyloom.functions.text import BLOCKED_REPLY_PATTERNS, MESSAGE_MAX_CHARS, SUGGESTION_START

# ---- fixed values ----------------------------------------------------------
DECISIONS = ("auto_handle", "escalate")
INTENTS = (
    "account_access",
    "billing_subscription",
    "playback_app_issue",
    "account_security",
    "feature_availability",
    "plan_change_cancel",
    "service_outage",
    "complaint_feedback",
    "other_unclear",
)
ALWAYS_ESCALATE = ("account_security", "billing_subscription", "plan_change_cancel")
AUTO_HANDLE = ("account_access", "playback_app_issue", "feature_availability")
RISK_TERMS = (
    "hacked",
    "stolen",
    "fraud",
    "chargeback",
    "unauthorized",
    "unauthorised",
    "compromised",
    "refund",
    "charged",
    "cancel",
    "legal",
    "lawsuit",
    "privacy",
    "suicidal",
    "threat",
)
REPLY_TEMPLATES = {
    "account_access": "Sorry you're having trouble getting into your account. Please do not share credentials or personal details here.",
    "billing_subscription": "I understand the billing concern. For your privacy, please do not post payment or account details publicly. A support specialist should review the account-specific charge.",
    "playback_app_issue": "Sorry about the playback problem. Could you share your device, app version, and whether it happens on another network?",
    "account_security": "Please secure your account immediately and do not share credentials publicly. This needs review by an account-security specialist.",
    "feature_availability": "Thanks for checking. Please share the feature and device you are asking about.",
    "plan_change_cancel": "A support specialist should review this plan-change request. No account change has been performed by this demo.",
    "service_outage": "Please check the current official service status. This demo cannot verify a live outage.",
    "complaint_feedback": "Thanks for raising this, and sorry for the frustration. A support specialist should review your feedback.",
    "other_unclear": "Thanks for contacting us. Could you share what you expected, what happened instead, and the device or platform involved?",
}
GENERIC_REPLY = "Thanks for contacting support. A human support specialist will review this."
ESCALATION_SUFFIX = " Human review is recommended; this demo has not opened a support ticket."
GUIDANCE_PREFIX = " A similar historical support case suggested: "
HUMAN_LABEL_SOURCE = "human"
WEAK_LABEL_SOURCE = "weak_keyword_rule_not_human_ground_truth"
# ---- end of fixed values ---------------------------------------------------


@dataclass(frozen=True)
class Policy:
    confidence_threshold: float = 0.72
    margin_threshold: float = 0.15
    similarity_threshold: float = 0.35
    always_escalate: tuple[str, ...] = ALWAYS_ESCALATE
    auto_handle: tuple[str, ...] = AUTO_HANDLE
    risk_terms: tuple[str, ...] = RISK_TERMS


@dataclass(frozen=True)
class TriageConfig:
    seed: int = 42
    intents: tuple[str, ...] = INTENTS
    policy: Policy = field(default_factory=Policy)
    # None: every usable pair, every term, messages of any length.
    max_corpus_size: int | None = None
    max_features: int | None = None
    max_message_chars: int | None = MESSAGE_MAX_CHARS
    top_k: int = 3
    # What keeps a reply from being quoted, and how a sentence worth quoting starts.
    blocked_patterns: tuple[str, ...] = BLOCKED_REPLY_PATTERNS
    suggestion_start: str = SUGGESTION_START
    reply_templates: dict[str, str] = field(default_factory=lambda: dict(REPLY_TEMPLATES))
