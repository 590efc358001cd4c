"""Readers that turn raw documents into typed rows."""
