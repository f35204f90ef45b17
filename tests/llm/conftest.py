from hypothesis import settings

settings.register_profile("shared machine", deadline=None)
settings.load_profile("shared machine")
