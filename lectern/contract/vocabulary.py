"""Closed vocabularies of the input contract. Fixed values."""

READER_GRAINS = ("resolved_person",)
CHANNELS = ("web", "app")
DELIVERY, INTERACTION = "content_delivery", "content_interaction"
EVENT_KINDS = (DELIVERY, INTERACTION)
CONTENT_TYPES = ("article", "liveblog", "gallery", "video", "podcast", "newsletter", "other")
RESOLVED, UNRESOLVED = "resolved", "unresolved"
RESOLUTIONS = (RESOLVED, UNRESOLVED)
STATES = ("registered_unpaid", "trial", "active", "grace", "payment_failed", "cancelled", "expired")
PAYERS = ("individual", "institutional", "guest")
#: Action kinds and the columns that count them.
ACTION_COLUMNS = {
    "post_created": "posts_created",
    "reply_created": "replies_created",
    "like_given": "likes_given",
    "dislike_given": "dislikes_given",
    "flag_given": "flags_given",
}
ACTIONS = tuple(ACTION_COLUMNS)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
WEEK_ENDS_ON, WEEK_STARTS_ON = "week_ends_on", "week_starts_on"
AVAILABLE, NOT_DEPLOYED, NOT_YET_LAUNCHED = "available", "not_deployed", "not_yet_launched"
AVAILABILITIES = (AVAILABLE, NOT_DEPLOYED, NOT_YET_LAUNCHED)
#: The section that stands for reading whose sections are unknown.
UNRESOLVED_SECTION = "__unresolved__"
