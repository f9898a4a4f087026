"""The staging projection applied to newly arriving raw files."""
